"""Gate evaluation over many runs at once (JN3, SCL4-SCL7, AGG15, AGG16, CMP3).

Runs meet their experiment's gates by an equi-join on ``experiment_id`` (the gate list
is read from a small configuration file) and their measured metrics by a left join on
(run_id, metric); a metric that is missing, NULL or NaN is NOT_MEASURED.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.functions import gates as G

EVALUATION_COLUMNS = [
    "run_id",
    "position",
    "gate_id",
    "metric",
    "gate_type",
    "op",
    "threshold",
    "measured_value",
    "passed",
    "details",
    "label",
]


def metrics_long(wide: DataFrame) -> DataFrame:
    """(run_id, metric, value) from a frame with ``run_id`` and one column per metric."""
    names = [c for c in wide.columns if c != "run_id"]
    typed = wide.select("run_id", *[F.col(c).cast("double").alias(c) for c in names])
    return typed.unpivot(["run_id"], names, "metric", "value")


def run_metrics(
    runs: DataFrame,
    health: DataFrame | None = None,
    fidelity: DataFrame | None = None,
    quality: DataFrame | None = None,
    coverage: DataFrame | None = None,
) -> DataFrame:
    """Measured metrics per run, long form (run_id, metric, value), from per-run frames
    keyed by ``run_id``.

    ``health``: health_score, columns_drifted, total_columns_checked.
    ``fidelity``: row_count_ratio. ``quality``: quality_pass_ratio, quarantine_ratio.
    ``coverage``: provenance_field_coverage. Each input contributes its own rows and the
    parts are unioned, so no join is needed: a run missing from an input (or a NULL
    value) simply has no measured value, which the gate join reports as NOT_MEASURED.
    """

    def long(df: DataFrame, pairs: dict[str, Column]) -> DataFrame:
        rows = [F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in pairs.items()]
        return df.select("run_id", F.inline(F.array(*rows)))

    parts = []
    if health is not None:
        ratio = F.try_divide(F.col("columns_drifted").cast("double"), F.col("total_columns_checked").cast("double"))
        parts.append(long(health, {"entropy_health_score": F.col("health_score"), "entropy_columns_drifted_ratio": ratio}))
    if fidelity is not None:
        parts.append(long(fidelity, {"bronze_record_fidelity_ratio": F.col("row_count_ratio")}))
    if quality is not None:
        parts.append(
            long(
                quality,
                {"silver_quality_pass_ratio": F.col("quality_pass_ratio"), "silver_quarantine_ratio": F.col("quarantine_ratio")},
            )
        )
    if coverage is not None:
        parts.append(long(coverage, {"provenance_field_coverage": F.col("provenance_field_coverage")}))
    if not parts:
        return runs.sparkSession.createDataFrame([], "run_id string, metric string, value double")
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


UNMATCHED = "UNMATCHED"


def evaluate_gates(gates: DataFrame, runs: DataFrame, metrics: DataFrame, config: DataFrame | None = None) -> DataFrame:
    """One row per (run, gate): measured value, passed (NULL if unmeasured or unknown op),
    details text and display label.

    A run whose experiment has no gates (an unknown or NULL id) gets one unmeasured row,
    gate id ``UNMATCHED`` at position 0, so that it cannot pass; only an experiment that
    ``config`` lists with an empty array of gates is let through without any. A metric with
    several values (a run over several tables) counts once, at its worst: unmeasured, then
    not passed, then passed.
    """
    pairs = runs.select("run_id", "experiment_id").join(gates.withColumnRenamed("experiment_id", "_x"), F.col("experiment_id") == F.col("_x"), "left")
    if config is not None:
        listed = config.filter(F.size("gates") == 0).select(F.coalesce("experiment_id", F.lit("")).alias("_none")).distinct()
        pairs = pairs.join(listed, F.col("experiment_id") == F.col("_none"), "left").filter(F.col("_x").isNotNull() | F.col("_none").isNull()).drop("_none")
    pairs = pairs.withColumns({"position": F.coalesce("position", F.lit(0)), "gate_id": F.coalesce("gate_id", F.lit(UNMATCHED))}).drop("_x")
    m = metrics.select("run_id", "metric", G.measured(F.col("value").cast("double")).alias("measured_value"))
    j = pairs.join(m, ["run_id", "metric"], "left")
    v, op, t = F.col("measured_value"), F.col("op"), F.col("threshold")
    passed = F.when(v.isNull(), F.lit(None).cast("boolean")).otherwise(G.compare(v, op, t))
    rows = (
        j.withColumn("passed", passed)
        .withColumn("details", G.details(v, op, t))
        .withColumn("label", G.label(F.col("passed"), F.col("gate_type")))
        .select(EVALUATION_COLUMNS)
    )
    rank = F.when(v.isNull(), 0).when(~F.col("passed"), 1).when(F.col("passed").isNull(), 2).otherwise(3)
    return rows.groupBy("run_id", "position", "gate_id").agg(
        F.min_by(F.struct(*EVALUATION_COLUMNS), F.struct(rank, v)).alias("_e")
    ).select("_e.*")


def verdicts(runs: DataFrame, evaluations: DataFrame) -> DataFrame:
    """One row per run (AGG15, AGG16, SCL6).

    INCOMPLETE if any gate is unmeasured; else FAIL if a FAIL gate did not pass; else
    WARN if a WARN gate did not pass; else PASS (also for a run whose experiment lists no gates). An unknown
    op gives passed NULL, which does not vote.
    """
    v = F.col("measured_value")
    failed = F.col("passed") == F.lit(False)
    per_run = evaluations.groupBy("run_id").agg(
        F.count_if(v.isNull()).alias("_unmeasured"),
        F.count_if(failed & (F.col("gate_type") == G.FAIL)).alias("_fail"),
        F.count_if(failed & (F.col("gate_type") == G.WARN)).alias("_warn"),
        F.count_if(F.col("position") > 0).alias("gates_evaluated"),
        F.sort_array(
            F.collect_list(F.when(v.isNull(), F.struct(F.col("position"), F.col("gate_id"))))
        ).alias("_um"),
    )
    j = runs.select("run_id").join(per_run, "run_id", "left")
    verdict = (
        F.when(F.coalesce(F.col("_unmeasured"), F.lit(0)) > 0, F.lit(G.INCOMPLETE))
        .when(F.coalesce(F.col("_fail"), F.lit(0)) > 0, F.lit(G.FAIL))
        .when(F.coalesce(F.col("_warn"), F.lit(0)) > 0, F.lit(G.WARN))
        .otherwise(F.lit(G.PASS))
    )
    unmeasured = F.transform(F.coalesce(F.col("_um"), F.array()), lambda s: s["gate_id"])
    return j.select(
        "run_id",
        verdict.alias("overall_verdict"),
        F.coalesce(F.col("gates_evaluated"), F.lit(0)).cast("long").alias("gates_evaluated"),
        unmeasured.alias("unmeasured_gates"),
    ).withColumn("gold_allowed", G.gold_allowed(F.col("overall_verdict")))
