"""Simulated source failures and the spot checks that (fail to) notice them (PRJ10-PRJ12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.functions.columns import ref


def collapse(df: DataFrame, column: str, value) -> DataFrame:
    """Every value of ``column`` becomes one literal (a source defaulting a field)."""
    return df.withColumn(column, F.lit(value).cast(df.schema[column].dataType))


def override_where(df: DataFrame, column: str, value, predicate: Column) -> DataFrame:
    """Rows matching ``predicate`` get ``value`` in ``column`` (deterministic override)."""
    typed = F.lit(value).cast(df.schema[column].dataType)
    return df.withColumn(column, F.when(predicate, typed).otherwise(ref(column)))


def override_share(df: DataFrame, column: str, value, share: float = 0.95, seed: int = 42) -> DataFrame:
    """About ``share`` of the rows get ``value`` (a flat-rate override), chosen by ``rand(seed)``."""
    return override_where(df, column, value, F.rand(seed) < F.lit(share))


def spot_checks(df: DataFrame, column: str, value) -> DataFrame:
    """One pass: rows equal to ``value``, NULL rows, distinct values (NULL counted), total."""
    c = ref(column)
    return df.agg(
        F.count_if(c == F.lit(value).cast(df.schema[column].dataType)).alias("matching_rows"),
        F.count_if(c.isNull()).alias("null_rows"),
        (F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))).cast("long").alias("distinct_values"),
        F.count(F.lit(1)).alias("total_rows"),
    )
