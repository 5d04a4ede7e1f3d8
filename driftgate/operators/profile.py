"""Entropy profiles: value frequencies and per-column Shannon entropy, in one pass.

Plan shape for C monitored columns (any number of tables):

    scan (only the monitored columns) -> Expand (unpivot to (table, column, value))
      -> partial count by (table, column, value) -> Exchange -> final count
      -> partial sums by (table, column)         -> Exchange -> final sums
      -> broadcast join to a tiny (table, column) spine so empty inputs still give rows

One scan and two exchanges instead of one job per column and statistic. A hot value
(even one holding a third of all rows) collapses to one row per task in the map-side
partial aggregate, so neither exchange is skewed by it. The second aggregate has at most
C groups and only sees one partial row per column per task. Entropy uses the identity
H = log2(n) - sum(f*log2 f)/n, so no window over all values of a column is needed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from driftgate.functions.columns import monitored_columns
from driftgate.functions.entropy import (
    category,
    category_key_sql,
    entropy_class_sql,
    round_exact_sql,
)

PROFILE_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("column_name", StringType(), False),
        StructField("entropy", DoubleType(), False),
        StructField("normalized_entropy", DoubleType(), False),
        StructField("distinct_count", LongType(), False),
        StructField("null_count", LongType(), False),
        StructField("null_ratio", DoubleType(), False),
        StructField("total_count", LongType(), False),
        StructField("entropy_class", StringType(), False),
    ]
)
PROFILE_COLUMNS = [f.name for f in PROFILE_SCHEMA.fields]

_SPINE_SCHEMA = StructType(
    [
        StructField("_t", IntegerType(), False),
        StructField("_c", IntegerType(), False),
        StructField("table_name", StringType(), False),
        StructField("column_name", StringType(), False),
    ]
)


def _long_form(df: DataFrame, cols: Sequence[str], table_index: int) -> DataFrame:
    """(_t, _c, _v): one row per (row, monitored column) with the category as a string."""
    types = {f.name: f.dataType for f in df.schema.fields}
    wide = df.select([category(c, types[c]).alias(str(i)) for i, c in enumerate(cols)])
    long = wide.unpivot([], [str(i) for i in range(len(cols))], "_c", "_v")
    return long.select(
        F.lit(table_index).alias("_t"), F.col("_c").cast("int").alias("_c"), F.col("_v")
    )


def _keys(df: DataFrame, cols: Sequence[str], first: int) -> DataFrame:
    """(_n, _l, _h): one row per (row, monitored column) with the category's key; the columns are
    numbered from ``first`` over all tables, so that one number names table and column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    rows = ", ".join(f"{i}, {', '.join(category_key_sql(c, types[c]))}" for i, c in enumerate(cols, start=first))
    return df.selectExpr(f"stack({len(cols)}, {rows}) AS (_n, _l, _h)")


def _plan(frames: Mapping[str, DataFrame], columns, exclude_columns):
    spine_rows, longs = [], []
    for t, (name, df) in enumerate(frames.items()):
        cols_for = columns.get(name) if isinstance(columns, Mapping) else columns
        excl_for = exclude_columns.get(name) if isinstance(exclude_columns, Mapping) else exclude_columns
        cols = monitored_columns(df, cols_for, excl_for)
        if not cols:
            continue
        longs.append(_keys(df, cols, len(spine_rows)))
        spine_rows += [(t, len(spine_rows) + i, name, c) for i, c in enumerate(cols)]
    return spine_rows, longs


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _spine(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, _SPINE_SCHEMA)


def profile_tables(
    frames: Mapping[str, DataFrame],
    columns: Sequence[str] | Mapping[str, Sequence[str]] | None = None,
    exclude_columns: Iterable[str] | Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """Entropy profile of every monitored column of every table, as one Spark job.

    ``frames`` maps a table name to its DataFrame. ``columns`` / ``exclude_columns``
    apply to all tables, or per table when given as a mapping. One output row per
    monitored column, also when a table is empty. Schema: ``PROFILE_SCHEMA``.
    """
    if not frames:
        raise ValueError("profile_tables needs at least one table")
    spark = next(iter(frames.values())).sparkSession
    spine_rows, longs = _plan(frames, columns, exclude_columns)
    if not longs:
        return spark.createDataFrame([], PROFILE_SCHEMA)

    long = _union_all(longs)
    freq = long.groupBy("_n", "_l", "_h").agg(F.count(F.lit(1)).alias("_f"))
    f = F.col("_f")
    stats = freq.groupBy(F.col("_n").alias("_c")).agg(
        F.sum(f).alias("_n"),
        F.count(F.lit(1)).alias("_d"),
        F.sum(f * F.log2(f.cast("double"))).alias("_s"),
        F.sum(F.when(F.col("_l").isNull(), f).otherwise(F.lit(0))).alias("_null"),
    )
    joined = _spine(spark, spine_rows).join(F.broadcast(stats), "_c", "left")
    return _finish(joined)


def _finish(joined: DataFrame) -> DataFrame:
    """Profile columns from the per-column sums, as three SQL projections (cheap to build)."""
    base = joined.selectExpr(
        "table_name",
        "column_name",
        "CAST(coalesce(_n, 0) AS BIGINT) AS total_count",
        "CAST(coalesce(_d, 0) AS BIGINT) AS distinct_count",
        "CAST(coalesce(_null, 0) AS BIGINT) AS null_count",
        "CAST(coalesce(_s, 0.0) AS DOUBLE) AS _s",
    )
    h = round_exact_sql("log2(CAST(total_count AS DOUBLE)) - _s / CAST(total_count AS DOUBLE)", 6)
    hn = round_exact_sql("entropy / log2(CAST(distinct_count AS DOUBLE))", 6)
    ratio = round_exact_sql("null_count / total_count", 4)
    with_h = base.selectExpr(
        "*", f"CASE WHEN distinct_count <= 1 THEN CAST(0.0 AS DOUBLE) ELSE {h} END AS entropy"
    )
    with_n = with_h.selectExpr(
        "*",
        f"CASE WHEN distinct_count <= 1 THEN CAST(0.0 AS DOUBLE) ELSE {hn} END AS normalized_entropy",
        f"CASE WHEN total_count > 0 THEN {ratio} ELSE CAST(0.0 AS DOUBLE) END AS null_ratio",
    )
    return with_n.selectExpr(
        *PROFILE_COLUMNS[:-1],
        f"{entropy_class_sql('entropy', 'normalized_entropy', 'distinct_count')} AS entropy_class",
    )


def profile(
    df: DataFrame,
    table_name: str = "table",
    columns: Sequence[str] | None = None,
    exclude_columns: Iterable[str] | None = None,
) -> DataFrame:
    """Entropy profile of one table (AGG7): one row per monitored column."""
    return profile_tables({table_name: df}, columns, exclude_columns)


def value_frequencies(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude_columns: Iterable[str] | None = None,
    table_name: str = "table",
) -> DataFrame:
    """(table_name, column_name, value, frequency) for every monitored column (AGG1).

    ``value`` is the category string; NULL is a category of its own.
    """
    spark = df.sparkSession
    cols = monitored_columns(df, columns, exclude_columns)
    if not cols:
        schema = "table_name string, column_name string, value string, frequency bigint"
        return spark.createDataFrame([], schema)
    freq = (
        _long_form(df, cols, 0)
        .groupBy("_t", "_c", "_v")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    spine = _spine(spark, [(0, i, table_name, c) for i, c in enumerate(cols)])
    return freq.join(F.broadcast(spine), ["_t", "_c"]).select(
        "table_name", "column_name", F.col("_v").alias("value"), "frequency"
    )


def column_entropy(df: DataFrame, column_name: str) -> DataFrame:
    """One-row frame with the entropy of one column (AGG2, AGG6)."""
    return profile(df, columns=[column_name], exclude_columns=[]).select(
        "column_name", "entropy", "total_count"
    )


def with_measurement(profile_df: DataFrame, measurement_ts: Column | str | None = None) -> DataFrame:
    """Add ``measurement_ts`` (SRC4). Pass a literal to make a stored profile repeatable.

    ``None`` uses ``current_timestamp()``, which Spark fixes once per query.
    """
    if measurement_ts is None:
        ts = F.current_timestamp()
    elif isinstance(measurement_ts, Column):
        ts = measurement_ts
    else:
        ts = F.lit(measurement_ts).cast("timestamp")
    return profile_df.withColumn("measurement_ts", ts)
