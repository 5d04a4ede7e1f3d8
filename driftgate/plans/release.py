"""End-to-end release control (CMP2, CMP4): profile, drift, health, fidelity, ledger, gates.

Results are DataFrames; no row of them is collected. Building a release runs jobs: the profiles or
the health, a few rows per table, are checkpointed because several results read them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.functions.entropy import DEFAULT_DROP_PCT, DEFAULT_HEALTH_FLOOR, DEFAULT_SPIKE_PCT
from driftgate.operators.baseline import latest_baseline
from driftgate.operators.drift import DRIFT_COLUMNS, _drift_of_pairs, _health, paired_union, table_health
from driftgate.operators.fidelity import fidelity as fidelity_of
from driftgate.operators.fidelity import row_fidelity_many
from driftgate.operators.gates import evaluate_gates, run_metrics, verdicts
from driftgate.operators.ledger import build_ledger, provenance_coverage
from driftgate.operators.profile import profile_tables
from driftgate.operators.quality import evaluate as quality_of
from driftgate.session import materialize_small
from driftgate.sources.readers import gates_frame, thresholds_frame

RUN_FIELDS = (
    "experiment_id",
    "run_id",
    "git_commit",
    "git_branch",
    "catalog_name",
    "operator",
    "started_at_utc",
    "completed_at_utc",
    "status",
)

_BASE, _CUR = "\u0000baseline", "\u0000current"


def runs_frame(spark: SparkSession, runs: Iterable[Mapping]) -> DataFrame:
    """Run context rows (run metadata, not data) as a frame."""
    rows = [tuple(r.get(f) for f in RUN_FIELDS) + (r.get("table_name"),) for r in runs]
    schema = ", ".join(f"{f} string" for f in RUN_FIELDS) + ", table_name string"
    return spark.createDataFrame(rows, schema)


def measure_and_evaluate(
    baseline: DataFrame,
    current: DataFrame,
    table_name: str,
    exclude_columns: Iterable[str] | None = None,
    weights: Mapping | DataFrame | None = None,
    thresholds: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Profiles of both loads (one job), per-column drift and table health (CMP2).

    Health is materialised (a few rows per table, checkpointed): the ledger, the metrics
    and the verdict all read it, and would otherwise each rescan both loads.
    """
    both = profile_tables({_BASE: baseline, _CUR: current}, exclude_columns=exclude_columns)
    sided = both.withColumns(
        {"_side": F.when(F.col("table_name") == _BASE, 0).otherwise(1), "table_name": F.lit(table_name)}
    )
    d = _drift_of_pairs(paired_union(sided), DEFAULT_DROP_PCT, DEFAULT_SPIKE_PCT, thresholds)
    health = materialize_small(_health(d, weights, DEFAULT_HEALTH_FLOOR, thresholds))
    drift = d.filter(F.col("_matched")).select(DRIFT_COLUMNS)
    return {
        "baseline_profile": sided.filter(F.col("_side") == 0).drop("_side"),
        "current_profile": sided.filter(F.col("_side") == 1).drop("_side"),
        "drift": drift,
        "health": health,
    }


@dataclass
class Release:
    baseline_profile: DataFrame
    current_profile: DataFrame
    drift: DataFrame
    health: DataFrame
    fidelity: DataFrame
    ledger: DataFrame
    evaluations: DataFrame
    verdict: DataFrame


def release_control(
    baseline: DataFrame,
    current: DataFrame,
    table_name: str,
    config: DataFrame,
    run: Mapping,
    exclude_columns: Iterable[str] | None = None,
    quality: DataFrame | None = None,
    quality_pass_ratio: float | None = None,
    quarantine_ratio: float | None = None,
    source: DataFrame | None = None,
    target: DataFrame | None = None,
    weights: Mapping | DataFrame | None = None,
) -> Release:
    """Full release decision for one load of one table (CMP4).

    ``config`` is ``read_config(...)``. ``run`` holds the run context (see RUN_FIELDS).
    Fidelity compares ``source`` with ``target`` (default: baseline with current, as the
    reference demo does). Quality ratios come from ``quality`` (a frame with
    quality_pass_ratio, quarantine_ratio, e.g. ``QualityOutcome.ratios``) or are given.
    """
    spark = baseline.sparkSession
    runs = runs_frame(spark, [{**run, "table_name": table_name}])
    th = runs.select("experiment_id", "table_name").join(thresholds_frame(config), "experiment_id", "left")
    measured = measure_and_evaluate(
        baseline, current, table_name, exclude_columns, weights, thresholds=th
    )
    health = measured["health"].join(runs.select("run_id", "table_name"), "table_name")
    fid = fidelity_of(source if source is not None else baseline, target if target is not None else current)
    fid = fid.withColumn("run_id", F.lit(run["run_id"]))
    if quality is None:
        quality = spark.createDataFrame(
            [(run["run_id"], quality_pass_ratio, quarantine_ratio)],
            "run_id string, quality_pass_ratio double, quarantine_ratio double",
        )
    elif "run_id" not in quality.columns:
        quality = quality.withColumn("run_id", F.lit(run["run_id"]))
    tables = runs.select("run_id", "table_name")
    ledger = provenance_coverage(build_ledger(runs, health, tables))
    metrics = run_metrics(runs, health=health, fidelity=fid, quality=quality, coverage=ledger)
    gates = gates_frame(config)
    evaluations = evaluate_gates(gates, runs, metrics, config)
    verdict = verdicts(runs, evaluations).join(
        health.select("run_id", "table_name", "health_score", "columns_drifted", "total_columns_checked"),
        "run_id",
        "left",
    )
    return Release(
        measured["baseline_profile"],
        measured["current_profile"],
        measured["drift"],
        measured["health"],
        fid,
        ledger,
        evaluations,
        verdict,
    )


@dataclass
class ReleaseMany:
    health: DataFrame
    fidelity: DataFrame
    quality: DataFrame
    ledger: DataFrame
    metrics: DataFrame
    evaluations: DataFrame
    verdicts: DataFrame


def release_many(
    loads: Mapping[str, tuple[DataFrame, DataFrame]],
    config: DataFrame,
    runs: Iterable[Mapping],
    columns: Mapping[str, Iterable[str]] | None = None,
    exclude_columns: Iterable[str] | Mapping[str, Iterable[str]] | None = None,
    rules: Mapping[str, list] | None = None,
    weights: Mapping | DataFrame | None = None,
) -> ReleaseMany:
    """Release decisions for many tables (one run each) in one set of jobs.

    ``loads`` maps a table name to (baseline, current). ``runs`` carries the run context
    per run with its ``table_name``. All baselines are profiled in one job, all currents
    in another; all row counts in one job; quality ratios come from ``rules`` per table
    (tables without rules leave their quality gates NOT_MEASURED).
    """
    spark = config.sparkSession
    run_rows = runs_frame(spark, runs)
    keys = run_rows.select("run_id", "table_name")
    cols = {t: list(c) for t, c in columns.items()} if columns else None
    base = profile_tables({t: b for t, (b, _) in loads.items()}, cols, exclude_columns)
    cur = profile_tables({t: c for t, (_, c) in loads.items()}, cols, exclude_columns)
    th = run_rows.select("experiment_id", "table_name").join(thresholds_frame(config), "experiment_id", "left")
    # a few rows per table, read by the ledger and by the metrics: computed once
    health = materialize_small(table_health(base, cur, weights, thresholds=th)).join(keys, "table_name")
    fid = row_fidelity_many(loads).join(keys, "table_name")
    qual = _quality_ratios({t: c for t, (_, c) in loads.items()}, rules, keys)
    return _decide(config, run_rows, health, fid, qual)


def release_stored(
    history: DataFrame,
    loads: Mapping[str, DataFrame],
    config: DataFrame,
    runs: Iterable[Mapping],
    columns: Mapping[str, Iterable[str]] | None = None,
    exclude_columns: Iterable[str] | Mapping[str, Iterable[str]] | None = None,
    rules: Mapping[str, list] | None = None,
    weights: Mapping | DataFrame | None = None,
) -> ReleaseMany:
    """Release decisions of new loads against each table's newest stored baseline (``history``,
    e.g. ``read_baselines``): the old data is not read, and a load is scanned once to profile it
    and once for its rules. Row counts are those of the profiles. A table without a stored
    baseline has neither health nor fidelity, so its gates on them are NOT_MEASURED.
    """
    run_rows = runs_frame(config.sparkSession, runs)
    keys = run_rows.select("run_id", "table_name")
    cols = {t: list(c) for t, c in columns.items()} if columns else None
    cur = profile_tables(loads, cols, exclude_columns)
    fields = ["table_name", "column_name", "entropy", "total_count"]
    base = latest_baseline(history, list(loads)).select(*fields, F.lit(0).alias("_side"))
    # a few rows per table, read for health and for the row counts: computed once
    both = materialize_small(base.unionByName(cur.select(*fields, F.lit(1).alias("_side"))))
    rows = both.groupBy("table_name").agg(
        F.max(F.when(F.col("_side") == 0, F.col("total_count"))).alias("source_row_count"),
        F.max(F.when(F.col("_side") == 1, F.col("total_count"))).alias("target_row_count"),
    ).filter(F.col("source_row_count").isNotNull())
    ratio = F.try_divide(F.col("target_row_count").cast("double"), F.col("source_row_count").cast("double"))
    fid = rows.withColumn("row_count_ratio", ratio).join(keys, "table_name")
    th = run_rows.select("experiment_id", "table_name").join(thresholds_frame(config), "experiment_id", "left")
    d = _drift_of_pairs(paired_union(both.drop("total_count")), DEFAULT_DROP_PCT, DEFAULT_SPIKE_PCT, th)
    health = _health(d, weights, DEFAULT_HEALTH_FLOOR, th).join(rows, "table_name", "left_semi").join(keys, "table_name")
    return _decide(config, run_rows, health, fid, _quality_ratios(loads, rules, keys))


def _quality_ratios(loads: Mapping[str, DataFrame], rules: Mapping[str, list] | None, keys: DataFrame) -> DataFrame:
    """Quality ratios per run of the tables that have rules."""
    ratios = [
        quality_of(loads[t], r).ratios.withColumn("table_name", F.lit(t))
        for t, r in (rules or {}).items()
        if r
    ]
    if ratios:
        qual = ratios[0]
        for r in ratios[1:]:
            qual = qual.unionByName(r)
        return qual.join(keys, "table_name")
    return keys.sparkSession.createDataFrame([], "run_id string, quality_pass_ratio double, quarantine_ratio double")


def _decide(config: DataFrame, run_rows: DataFrame, health: DataFrame, fid: DataFrame, qual: DataFrame) -> ReleaseMany:
    keys = run_rows.select("run_id", "table_name")
    ledger = provenance_coverage(build_ledger(run_rows, health, keys))
    metrics = run_metrics(run_rows, health=health, fidelity=fid, quality=qual, coverage=ledger)
    evaluations = evaluate_gates(gates_frame(config), run_rows, metrics, config)
    return ReleaseMany(health, fid, qual, ledger, metrics, evaluations, verdicts(run_rows, evaluations))
