"""Derived test loads built from the given tables with deterministic predicates.

Each function reads a table of ``sf_dir`` and changes it the way a broken source would,
so drift, quality and fidelity checks have something to find. All are lazy frames.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.operators.simulate import collapse, override_where

EVENTS_SPLIT = "2024-01-16"


_READS: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read once per session and path: the same DataFrame (and so the same
    scan node) is reused, which also lets Spark reuse exchanges between branches."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (str(spark._jsparkSession.sessionUUID()), path)
    df = _READS.get(key)
    if df is None:
        df = _READS[key] = spark.read.parquet(path)
    return df


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def orders_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status collapses to 'F'; priority becomes '1-URGENT' except on every 20th order."""
    o = orders(spark, sf_dir)
    o = collapse(o, "o_orderstatus", "F")
    return override_where(o, "o_orderpriority", "1-URGENT", F.pmod(F.col("o_orderkey"), F.lit(20)) != 0)


def orders_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority NULL on every 7th order key."""
    o = orders(spark, sf_dir)
    return o.withColumn(
        "o_orderpriority",
        F.when(F.pmod(F.col("o_orderkey"), F.lit(7)) == 0, F.lit(None).cast("string")).otherwise(
            F.col("o_orderpriority")
        ),
    )


def customer_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation key NULL on every 11th customer key (non-positive balances occur naturally)."""
    c = table(spark, sf_dir, "customer")
    return c.withColumn(
        "c_nationkey",
        F.when(F.pmod(F.col("c_custkey"), F.lit(11)) == 0, F.lit(None).cast("int")).otherwise(
            F.col("c_nationkey")
        ),
    )


def part_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand collapses to 'Brand#11' on two of every three parts."""
    p = table(spark, sf_dir, "part")
    return override_where(p, "p_brand", "Brand#11", F.pmod(F.col("p_partkey"), F.lit(3)) != 0)


def events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.filter(F.col("ts") < F.lit(EVENTS_SPLIT).cast("timestamp_ntz"))


def events_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.filter(F.col("ts") >= F.lit(EVENTS_SPLIT).cast("timestamp_ntz"))


def with_lineage(df: DataFrame, source_system: str, source_name: str, ingest_ts: str) -> DataFrame:
    """Bronze-style lineage columns with a fixed ingest time."""
    return df.withColumns(
        {
            "ingest_ts": F.lit(ingest_ts).cast("timestamp"),
            "source_system": F.lit(source_system),
            "source_file_path": F.lit(source_name),
        }
    )
