"""Source-to-target fidelity: row-count ratio and column-name differences (AGG13, JN4, SET4, PRJ9)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.functions.columns import CDF_COLUMNS


def row_fidelity(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: source and target row counts and target/source (NULL if the source is empty).

    Each side is one global count (map-side partial counts, one row shuffled per task);
    the source count enters the target's aggregate as a scalar subquery.
    """
    src = source.select(F.count(F.lit(1))).scalar()
    tgt = target.agg(F.count(F.lit(1)).alias("target_row_count"))
    return tgt.select(
        src.cast("long").alias("source_row_count"),
        F.col("target_row_count").cast("long"),
    ).withColumn(
        "row_count_ratio",
        F.try_divide(F.col("target_row_count").cast("double"), F.col("source_row_count").cast("double")),
    )


def row_fidelity_many(pairs) -> DataFrame:
    """(table_name, source_row_count, target_row_count, row_count_ratio) for many
    (source, target) pairs in one job: each side contributes only a literal per row, so the
    scans read no columns, and one grouped count combines map-side."""
    sides = []
    for name, (src, tgt) in pairs.items():
        sides.append(src.select(F.lit(name).alias("table_name"), F.lit(True).alias("_src")))
        sides.append(tgt.select(F.lit(name).alias("table_name"), F.lit(False).alias("_src")))
    union = sides[0]
    for s in sides[1:]:
        union = union.unionByName(s)
    counts = union.groupBy("table_name").agg(
        F.count_if(F.col("_src")).cast("long").alias("source_row_count"),
        F.count_if(~F.col("_src")).cast("long").alias("target_row_count"),
    )
    return counts.withColumn(
        "row_count_ratio",
        F.try_divide(F.col("target_row_count").cast("double"), F.col("source_row_count").cast("double")),
    )


def _names(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in dict.fromkeys(names)], "column_name string")


def schema_diff(
    spark: SparkSession,
    source_columns: Sequence[str],
    target_columns: Sequence[str],
    ignore: Iterable[str] = CDF_COLUMNS,
) -> DataFrame:
    """(kind, column_name, mismatch): names only in the source are ``missing_in_target``,
    names only in the target (minus change-feed metadata) are ``extra_in_target``.
    Case-sensitive; types and order are ignored."""
    src = _names(spark, source_columns)
    tgt = _names(spark, [c for c in target_columns if c not in set(ignore)])
    missing = src.join(tgt, "column_name", "left_anti").select(
        F.lit("missing_in_target").alias("kind"), "column_name"
    )
    extra = tgt.join(src, "column_name", "left_anti").select(
        F.lit("extra_in_target").alias("kind"), "column_name"
    )
    return missing.unionByName(extra).withColumn(
        "mismatch", F.concat(F.col("kind"), F.lit(":"), F.col("column_name"))
    )


def fidelity(source: DataFrame, target: DataFrame, ignore: Iterable[str] = CDF_COLUMNS) -> DataFrame:
    """One row: row counts, ratio, ``columns_match`` and ``mismatched_columns``
    (missing first, then extra, each sorted by name)."""
    spark = source.sparkSession
    diff = schema_diff(spark, source.columns, target.columns, ignore)
    ordered = F.struct((F.col("kind") != "missing_in_target").alias("k"), F.col("column_name"), F.col("mismatch"))
    mism = diff.agg(F.sort_array(F.collect_list(ordered)).alias("_m")).select(
        F.transform(F.col("_m"), lambda s: s["mismatch"]).alias("mismatched_columns")
    )
    mism_scalar = mism.scalar()
    return row_fidelity(source, target).select(
        "*",
        mism_scalar.alias("mismatched_columns"),
    ).withColumn("columns_match", F.size(F.col("mismatched_columns")) == 0).select(
        "source_row_count", "target_row_count", "row_count_ratio", "columns_match", "mismatched_columns"
    )
