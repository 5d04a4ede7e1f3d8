"""Drift between a baseline and a current profile, and the weighted table health score.

Both inputs are profile frames (one row per table and column), so every join here is
between frames of at most tables x columns rows. No broadcast is forced: adaptive query
execution measures the actual sizes at runtime and broadcasts when they are small,
falling back to a sort-merge join otherwise. Many tables are evaluated in one job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from driftgate.functions.entropy import (
    DEFAULT_DROP_PCT,
    DEFAULT_HEALTH_FLOOR,
    DEFAULT_SPIKE_PCT,
    drift_columns,
    round_exact,
)

KEYS = ["table_name", "column_name"]
DRIFT_COLUMNS = [
    "table_name",
    "column_name",
    "baseline_entropy",
    "current_entropy",
    "drift_detected",
    "drift_direction",
    "drift_magnitude",
    "stability_score",
]


def _as_column(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def paired(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """(table_name, column_name, baseline_entropy, current_entropy, _in_b, _in_c).

    One grouped aggregate over the union of both profiles instead of a join plus a
    separate table list: each profile is referenced once, so neither is recomputed.
    """
    u = _measured(baseline).withColumn("_side", F.lit(0)).unionByName(_measured(current).withColumn("_side", F.lit(1)))
    return paired_union(u)


def _measured(profile: DataFrame) -> DataFrame:
    at = F.col("measurement_ts") if "measurement_ts" in profile.columns else F.lit(None)
    return profile.select(*KEYS, "entropy", at.cast("timestamp").alias("_at"))


def _newest(where: Column | None = None) -> Column:
    """The entropy of a column's row: of several, the newest; of equally new ones, the largest."""
    row = F.struct("_at", "_e")
    return F.max(row if where is None else F.when(where, row))["_e"]


def paired_union(u: DataFrame) -> DataFrame:
    """``paired`` over one frame of both profiles with ``_side`` 0 (baseline) / 1 (current)."""
    side = "_side"
    u = u.withColumnRenamed("entropy", "_e")
    if "_at" not in u.columns:
        u = u.withColumn("_at", F.lit(None).cast("timestamp"))
    return u.groupBy(*KEYS).agg(
        _newest(F.col(side) == 0).alias("baseline_entropy"),
        _newest(F.col(side) == 1).alias("current_entropy"),
        (F.count_if(F.col(side) == 0) > 0).alias("_in_b"),
        (F.count_if(F.col(side) == 1) > 0).alias("_in_c"),
    )


def _with_thresholds(pairs: DataFrame, drop_pct, spike_pct, thresholds: DataFrame | None):
    drop, spike = _as_column(drop_pct), _as_column(spike_pct)
    if thresholds is not None:
        pairs = pairs.join(
            thresholds.select(
                "table_name", F.col("drop_pct").alias("_drop"), F.col("spike_pct").alias("_spike")
            ),
            "table_name",
            "left",
        )
        drop = F.coalesce(F.col("_drop"), drop)
        spike = F.coalesce(F.col("_spike"), spike)
    return pairs, drop, spike


def _drift_of_pairs(pairs: DataFrame, drop_pct, spike_pct, thresholds) -> DataFrame:
    """All paired rows with drift columns (NULL where a column is on one side only)."""
    pairs, drop, spike = _with_thresholds(pairs, drop_pct, spike_pct, thresholds)
    matched = F.col("_in_b") & F.col("_in_c")
    exprs = drift_columns(F.col("baseline_entropy"), F.col("current_entropy"), drop, spike)
    return pairs.withColumns({k: F.when(matched, v) for k, v in exprs.items()}).withColumn("_matched", matched)


def column_drift(
    baseline: DataFrame,
    current: DataFrame,
    drop_pct: Column | float = DEFAULT_DROP_PCT,
    spike_pct: Column | float = DEFAULT_SPIKE_PCT,
    thresholds: DataFrame | None = None,
) -> DataFrame:
    """Per-column drift for the columns present in both profiles (JN1, SCL2).

    Columns on one side only are ignored (see ``unmatched_columns``). ``thresholds``
    may hold per-table ``drop_pct`` / ``spike_pct`` columns keyed by ``table_name``;
    tables absent from it use the scalar arguments.
    """
    d = _drift_of_pairs(paired(baseline, current), drop_pct, spike_pct, thresholds)
    return d.filter(F.col("_matched")).select(DRIFT_COLUMNS)


def unmatched_columns(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Columns profiled on one side only: (table_name, column_name, side)."""
    p = paired(baseline, current)
    return p.filter(~(F.col("_in_b") & F.col("_in_c"))).select(
        *KEYS,
        F.when(F.col("_in_c"), F.lit("current_only")).otherwise(F.lit("baseline_only")).alias("side"),
    )


def weights_frame(spark, weights: Mapping) -> DataFrame:
    """Weights as a frame. Keys are column names (all tables) or (table, column) pairs."""
    schema = StructType(
        [
            StructField("table_name", StringType(), True),
            StructField("column_name", StringType(), False),
            StructField("weight", DoubleType(), False),
        ]
    )
    rows = []
    for k, w in weights.items():
        t, c = (k if isinstance(k, tuple) else (None, k))
        rows.append((t, c, float(w)))
    return spark.createDataFrame(rows, schema)


def _apply_weights(drift: DataFrame, weights: DataFrame | Mapping | None) -> DataFrame:
    if weights is None:
        return drift.withColumn("weight", F.lit(1.0))
    if isinstance(weights, Mapping):
        weights = weights_frame(drift.sparkSession, weights)
    if "table_name" not in weights.columns:
        weights = weights.withColumn("table_name", F.lit(None).cast("string"))
    specific = weights.filter(F.col("table_name").isNotNull()).select(
        *KEYS, F.col("weight").cast("double").alias("_w_t")
    )
    generic = weights.filter(F.col("table_name").isNull()).select(
        "column_name", F.col("weight").cast("double").alias("_w_g")
    )
    out = drift.join(specific, KEYS, "left").join(generic, "column_name", "left")
    return out.withColumn(
        "weight", F.coalesce(F.col("_w_t"), F.col("_w_g"), F.lit(1.0))
    ).drop("_w_t", "_w_g")


_DETAIL_FIELDS = [
    "column_name",
    "baseline_entropy",
    "current_entropy",
    "drift_detected",
    "drift_direction",
    "drift_magnitude",
    "stability_score",
]


def _health(d: DataFrame, weights, health_floor, thresholds, rounded: bool = True, by=("table_name",)) -> DataFrame:
    """Health per table from rows with drift columns and ``_matched``; unmatched rows only
    make their table appear."""
    weighted = _apply_weights(d, weights)
    m = F.col("_matched")
    w, stab = F.col("weight"), F.col("stability_score")
    detail = F.struct(*[F.col(c) for c in _DETAIL_FIELDS])
    agg = weighted.groupBy(*by).agg(
        F.sum(F.when(m, stab * w)).alias("_ws"),
        F.sum(F.when(m, w)).alias("_w"),
        F.count_if(m).alias("total_columns_checked"),
        F.count_if(m & F.col("drift_detected")).alias("columns_drifted"),
        F.sort_array(F.collect_list(F.when(m, detail))).alias("column_details"),
    )
    floor = _as_column(health_floor)
    if thresholds is not None:
        agg = agg.join(
            thresholds.select("table_name", F.col("health_floor").alias("_floor")), "table_name", "left"
        )
        floor = F.coalesce(F.col("_floor"), floor)
    has_w = F.coalesce(F.col("_w"), F.lit(0.0)) > 0
    mean = F.col("_ws") / F.col("_w")
    score = F.when(has_w, round_exact(mean, 4) if rounded else mean).otherwise(F.lit(0.0))
    details = F.col("column_details")
    return agg.select(
        *by,
        score.alias("health_score"),
        (score >= floor).alias("passed_gate"),
        F.col("total_columns_checked").cast("int").alias("total_columns_checked"),
        F.col("columns_drifted").cast("int").alias("columns_drifted"),
        F.filter(details, lambda x: x["drift_detected"]).alias("flagged_columns"),
        details.alias("column_details"),
    )


def table_health(
    baseline: DataFrame,
    current: DataFrame,
    weights: DataFrame | Mapping | None = None,
    drop_pct: Column | float = DEFAULT_DROP_PCT,
    spike_pct: Column | float = DEFAULT_SPIKE_PCT,
    health_floor: Column | float = DEFAULT_HEALTH_FLOOR,
    thresholds: DataFrame | None = None,
    rounded: bool = True,
) -> DataFrame:
    """Composite health per table of baseline vs current profiles (CMP2 core).

    ``rounded=False`` keeps the unrounded mean (the notebook's composite score, AGG10).

    Every table that appears in either profile gets a row; one without common columns
    scores 0.0. ``thresholds`` may give per-table ``drop_pct``, ``spike_pct`` and
    ``health_floor``. Each profile is read once (see ``paired``).
    """
    d = _drift_of_pairs(paired(baseline, current), drop_pct, spike_pct, thresholds)
    return _health(d, weights, health_floor, thresholds, rounded)


def health_history(
    baseline: DataFrame,
    history: DataFrame,
    weights: DataFrame | Mapping | None = None,
    drop_pct: Column | float = DEFAULT_DROP_PCT,
    spike_pct: Column | float = DEFAULT_SPIKE_PCT,
    health_floor: Column | float = DEFAULT_HEALTH_FLOOR,
    thresholds: DataFrame | None = None,
) -> DataFrame:
    """Health of every measurement in an audit history against its table's baseline, in
    one job: one row per (table_name, measurement_ts) — the entropy trend of each table.

    ``baseline`` holds one profile per table (e.g. ``latest_baseline``); ``history`` holds
    many (``read_audit_log``). The baseline side is a few rows per column and the history is
    joined to it on (table, column); adaptive execution broadcasts it when it is small.
    Columns of a load without a baseline are ignored; a load with no common column scores 0.
    """
    b = _measured(baseline).withColumnRenamed("entropy", "_e").groupBy(*KEYS).agg(_newest().alias("baseline_entropy"))
    h = history.select("table_name", "measurement_ts", "column_name", F.col("entropy").alias("current_entropy"))
    j = h.join(b, KEYS, "left").withColumns(
        {"_in_b": F.col("baseline_entropy").isNotNull(), "_in_c": F.lit(True)}
    )
    d = _drift_of_pairs(j, drop_pct, spike_pct, thresholds)
    return _health(d, weights, health_floor, thresholds, by=("table_name", "measurement_ts"))


def drifted_ratio(health: DataFrame) -> DataFrame:
    """(table_name, drifted_ratio): drifted / checked, NULL when nothing was checked (AGG11)."""
    return health.select(
        "table_name",
        F.try_divide(
            F.col("columns_drifted").cast("double"), F.col("total_columns_checked").cast("double")
        ).alias("drifted_ratio"),
    )
