"""Column selection helpers (monitored columns, lineage exclusions, safe references)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: lineage columns excluded from drift by default,
# and the change-data-feed metadata columns ignored when schemas are compared.
LINEAGE_COLUMNS = ("source_system", "source_file_path", "ingest_ts")
CDF_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")


def ref(name: str) -> Column:
    """A column reference that survives dots and other special characters in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def monitored_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude_columns: Iterable[str] | None = None,
) -> list[str]:
    """Columns to profile: ``columns`` (or every column) minus ``exclude_columns``.

    ``exclude_columns=None`` means the lineage defaults; ``[]`` excludes nothing.
    Exclusion wins over an explicit ``columns`` list. An empty ``columns`` list
    means "all columns", as in the reference.
    """
    exclude = set(LINEAGE_COLUMNS if exclude_columns is None else exclude_columns)
    chosen = list(columns) if columns else list(df.columns)
    missing = [c for c in chosen if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in frame: {missing}")
    seen: set[str] = set()
    out = []
    for c in chosen:
        if c not in exclude and c not in seen:
            seen.add(c)
            out.append(c)
    return out
