"""Row identity: which row of which file a row is.

Rules that compare rows (duplicates, references, a user's own check) look at a few columns, yet must
mark whole rows. With an identity they work on thin rows (identity, key digest, order) and only the
identities of the failing rows come back to the full rows, so a 20,000-word text is not shuffled to be ranked.

``identified`` takes the identity from the files themselves (path and position), so it is the
same in every evaluation and after a lost executor. A frame that is not a plain scan has no such position;
``stored`` writes it once in the shared folder and identifies the written rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.session import written

#: The prefix ``__dg_`` is reserved.
ROW_ID = "__dg_row_id"
#: Identities of failing rows are broadcast up to this many (about 150 bytes each), else joined by shuffle.
BROADCAST_ROWS = 100_000


def identified(df: DataFrame) -> DataFrame:
    """``df`` (a Parquet scan, possibly with columns added or rows filtered, but no row repeated by a
    join or an explode) with ``__dg_row_id`` struct<file, at>."""
    try:
        return df.withColumn(ROW_ID, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")))
    except AnalysisException as e:
        raise ValueError("only rows of Parquet files have an identity of their own; use stored(df)") from e


def stored(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` written once and read back with ``__dg_row_id``."""
    return identified(written(df, name))


def is_identified(df: DataFrame) -> bool:
    return ROW_ID in df.columns


def flagged(df: DataFrame, ids: DataFrame, flag: str) -> DataFrame:
    """``df`` plus ``flag``: true where the row's identity is in ``ids`` (a written frame of distinct
    ``__dg_row_id``), else NULL."""
    marks = ids.select(F.col(ROW_ID).alias("_marked"), F.lit(True).alias(flag))
    if ids.count() <= BROADCAST_ROWS:
        marks = F.broadcast(marks)
    return df.join(marks, F.col(ROW_ID) == F.col("_marked"), "left").drop("_marked")
