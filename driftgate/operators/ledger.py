"""Run ledger: one provenance row per run and its field coverage (SNK6, AGG14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.sources.readers import PROVENANCE_FIELDS
from driftgate.sources.sinks import append, read, replace_rows

LEDGER_COLUMNS = [
    "experiment_id",
    "run_id",
    "git_commit",
    "git_branch",
    "catalog_name",
    "operator",
    "started_at_utc",
    "completed_at_utc",
    "entropy_health_score",
    "tables_processed",
    "columns_drifted",
    "verdict",
    "cost_estimate_usd",
]


def provenance_coverage(ledger: DataFrame, fields: Sequence[str] = PROVENANCE_FIELDS) -> DataFrame:
    """Adds ``provenance_field_coverage``: share of required fields that are non-empty.

    NULL, an empty string and a missing column all count as absent.
    """
    present = [
        F.when(F.length(F.coalesce(F.col(f).cast("string"), F.lit(""))) > 0, 1).otherwise(0)
        if f in ledger.columns
        else F.lit(0)
        for f in fields
    ]
    total = sum(present[1:], present[0]) if present else F.lit(0)
    share = (total / F.lit(len(fields))) if fields else F.lit(0.0)
    return ledger.withColumn("provenance_field_coverage", share.cast("double"))


def build_ledger(
    runs: DataFrame,
    health: DataFrame | None = None,
    tables: DataFrame | None = None,
) -> DataFrame:
    """Ledger rows from run context columns plus per-run health (SNK6).

    ``runs`` carries experiment_id, run_id, git_commit, git_branch, catalog_name,
    operator, started_at_utc, completed_at_utc, status and optionally cost_estimate_usd.
    ``health`` (run_id, health_score, columns_drifted) may miss a run: score NULL,
    drifted 0. ``tables`` (run_id, table_name) lists the tables a run processed.
    """
    j = runs
    if health is not None:
        j = j.join(
            health.select(
                "run_id",
                F.col("health_score").alias("_hs"),
                F.col("columns_drifted").alias("_cd"),
            ),
            "run_id",
            "left",
        )
    if tables is not None:
        per_run = tables.groupBy("run_id").agg(
            F.sort_array(F.collect_set("table_name")).alias("_tp")
        )
        j = j.join(per_run, "run_id", "left")
    col = lambda name, default: F.col(name) if name in j.columns else default
    return j.select(
        col("experiment_id", F.lit(None).cast("string")).alias("experiment_id"),
        F.col("run_id"),
        col("git_commit", F.lit(None).cast("string")).alias("git_commit"),
        col("git_branch", F.lit(None).cast("string")).alias("git_branch"),
        col("catalog_name", F.lit(None).cast("string")).alias("catalog_name"),
        col("operator", F.lit(None).cast("string")).alias("operator"),
        col("started_at_utc", F.lit(None).cast("string")).alias("started_at_utc"),
        col("completed_at_utc", F.lit(None).cast("string")).alias("completed_at_utc"),
        col("_hs", F.lit(None).cast("double")).cast("double").alias("entropy_health_score"),
        F.coalesce(col("_tp", F.lit(None)), F.array().cast("array<string>")).alias("tables_processed"),
        F.coalesce(col("_cd", F.lit(None)), F.lit(0)).cast("int").alias("columns_drifted"),
        col("status", F.lit(None).cast("string")).alias("verdict"),
        col("cost_estimate_usd", F.lit(None).cast("double")).cast("double").alias("cost_estimate_usd"),
    )


STARTED_ON = "started_on"


def append_ledger(ledger: DataFrame, target: str, fmt: str = "parquet", replace_runs: bool = False) -> None:
    """Append ledger rows (append-only run history).

    ``replace_runs`` keeps one row per run when a run is recorded again: the ledger is partitioned by
    the date a run started on, and of the dates being written the rows of the same runs are replaced
    (``sinks.replace_rows``). Runs without a start time share a partition.
    """
    rows = ledger.select(LEDGER_COLUMNS)
    if replace_runs:
        dated = rows.withColumn(STARTED_ON, F.coalesce(F.substring("started_at_utc", 1, 10), F.lit("")))
        dated = dated.withColumn(STARTED_ON, F.when(F.col(STARTED_ON) == "", "none").otherwise(F.col(STARTED_ON)))
        replace_rows(dated, target, STARTED_ON, ("run_id",), fmt)
    else:
        append(rows, target, fmt)


def read_ledger(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    return read(spark, target, fmt).select(LEDGER_COLUMNS)
