"""Baselines and the audit history: newest measurement per table (AGG17, PRJ8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_baseline(history: DataFrame, table_names: str | Sequence[str] | None = None) -> DataFrame:
    """All rows of each table's newest ``measurement_ts`` (ties on the newest time all return).

    Implemented as a per-table ``max`` (map-side partial aggregate, one row per table)
    joined back on (table_name, measurement_ts), instead of a window over each table's
    whole history: the join groups are one measurement's columns, so a long history
    never lands in a single task. The filter on ``table_name`` reaches the scan and
    prunes partitions when the history is partitioned by it.
    """
    if table_names is not None:
        names = [table_names] if isinstance(table_names, str) else list(table_names)
        history = history.filter(F.col("table_name").isin(names))
    newest = history.groupBy("table_name").agg(F.max("measurement_ts").alias("measurement_ts"))
    return history.join(newest, ["table_name", "measurement_ts"], "left_semi")
