"""Comparison, fidelity, bronze landing, baselines, ledger and simulation."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from driftgate.operators import bronze, compare, fidelity, ledger, simulate
from driftgate.operators.baseline import latest_baseline
from driftgate.operators.profile import PROFILE_COLUMNS
from driftgate.plans.release import release_control
from driftgate.plans import catalogue
from driftgate.sources import sinks


def letters(spark, counts: dict[str, int]):
    rows = [(k,) for k, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "v string")


def test_category_comparison_few_values_sorted(spark):
    b = letters(spark, {"b": 2, "a": 1})
    c = letters(spark, {"c": 3})
    rows = [(r.position, r.category, r.baseline_count, r.current_count) for r in compare.category_comparison(b, c, "v").orderBy("position").collect()]
    assert rows == [(1, "a", 1, 0), (2, "b", 2, 0), (3, "c", 0, 3)]


def test_category_comparison_top_and_others(spark):
    b = letters(spark, {f"b{i:02d}": 20 - i for i in range(10)})
    c = letters(spark, {"b00": 1, "zz": 50, "yy": 40, "b05": 30, "xx": 5})
    rows = compare.category_comparison(b, c, "v").orderBy("position").collect()
    cats = [r.category for r in rows]
    # top 4 of the baseline (b00..b03), then the current's top 4 (zz, yy, b05, xx): first 5 kept
    assert cats == ["b00", "b01", "b02", "b03", "zz", "Others"]
    others = rows[-1]
    assert others.baseline_count == sum(20 - i for i in range(4, 10)) and others.current_count == 40 + 30 + 5


def test_fidelity_and_schema_diff(spark):
    src = spark.range(10).withColumns({"a": F.lit(1), "b": F.lit(2)})
    tgt = spark.range(5).withColumns({"a": F.lit(1), "c": F.lit(3), "_change_type": F.lit("x")})
    r = fidelity.fidelity(src, tgt).collect()[0]
    assert (r.source_row_count, r.target_row_count, r.row_count_ratio) == (10, 5, 0.5)
    assert r.columns_match is False and r.mismatched_columns == ["missing_in_target:b", "extra_in_target:c"]
    empty = fidelity.row_fidelity(src.filter(F.lit(False)), tgt).collect()[0]
    assert empty.source_row_count == 0 and empty.row_count_ratio is None
    same = fidelity.fidelity(src, src.union(src)).collect()[0]
    assert same.columns_match and same.row_count_ratio == 2.0  # duplication is not caught (D16)
    many = {r.table_name: r.row_count_ratio for r in fidelity.row_fidelity_many({"x": (src, tgt), "y": (tgt, tgt)}).collect()}
    assert many == {"x": 0.5, "y": 1.0}


def test_bronze_dry_run_then_create_if_absent(spark, tmp_path):
    spark.range(3).withColumn("v", F.lit("a")).createOrReplaceTempView("bronze_src_t")
    schema = "bronze_test_" + uuid.uuid4().hex[:8]
    args = dict(source_system="sys", source_label="sys.t", ingest_ts="2024-01-01 00:00:00",
                location=str(tmp_path / "t"), schema_location=str(tmp_path / "schema"))
    dry = bronze.materialize(spark, "bronze_src_t", f"{schema}.t", dry_run=True, **args).collect()[0]
    assert (dry.executed, dry.target_exists_before, dry.target_exists_after, dry.statements_attempted, dry.statements_executed) == (False, False, False, 2, 0)
    first = bronze.materialize(spark, "bronze_src_t", f"{schema}.t", **args).collect()[0]
    assert (first.executed, first.target_exists_before, first.target_exists_after, first.statements_executed) == (True, False, True, 2)
    spark.range(10).withColumn("v", F.lit("b")).createOrReplaceTempView("bronze_src_t")
    bronze.materialize(spark, "bronze_src_t", f"{schema}.t", **args)
    landed = spark.table(f"{schema}.t")
    assert landed.count() == 3  # create-if-absent, not refresh (D15)
    assert set(landed.columns) == {"id", "v", "ingest_ts", "source_system", "source_file_path"}
    assert landed.select("source_system", "source_file_path").distinct().collect()[0].asDict() == {"source_system": "sys", "source_file_path": "sys.t"}


def test_latest_baseline_keeps_ties_and_many_tables(spark, tmp_path):
    o = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    path = str(tmp_path / "hist")
    cols = ["o_orderstatus", "o_orderpriority"]
    sinks.capture_baseline({"orders": o}, path, columns=cols, measurement_ts="2024-01-01 00:00:00")
    sinks.capture_baseline({"orders": o.limit(10)}, path, columns=cols, measurement_ts="2024-02-01 00:00:00")
    sinks.capture_baseline(
        {"orders": o, "nation": o}, path, columns=cols, measurement_ts="2024-02-01 00:00:00", replace_same_time=False
    )
    latest = latest_baseline(sinks.read_baselines(spark, path))
    per = {}
    for r in latest.collect():
        per.setdefault(r.table_name, set()).add(str(r.measurement_ts))
    assert per == {"orders": {"2024-02-01 00:00:00"}, "nation": {"2024-02-01 00:00:00"}}
    assert latest.filter("table_name = 'orders'").count() == 4  # two baselines tie on the newest time
    assert set(PROFILE_COLUMNS) <= set(latest.columns)


def test_ledger_without_health(spark):
    runs = spark.createDataFrame([("E", "r1", "s")], "experiment_id string, run_id string, status string")
    led = ledger.build_ledger(runs).collect()[0]
    assert led.entropy_health_score is None and led.columns_drifted == 0 and led.tables_processed == []
    assert led.verdict == "s"


def test_simulation(spark):
    df = spark.range(2000).withColumn("v", F.col("id") % 10)
    assert simulate.collapse(df, "v", 7).select("v").distinct().count() == 1
    share = simulate.override_share(df, "v", 99, share=0.95, seed=1).filter("v = 99").count() / 2000
    assert 0.9 < share < 1.0
    r = simulate.spot_checks(df, "v", 3).collect()[0]
    assert (r.matching_rows, r.null_rows, r.distinct_values, r.total_rows) == (200, 0, 10, 2000)


def test_release_control_outputs(spark):
    o = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    run = {"experiment_id": "DRIFTGATE_DEMO", "run_id": "r", "git_commit": "c", "git_branch": "b",
           "catalog_name": "k", "operator": "o", "started_at_utc": "t", "status": "EXECUTION_COMPLETED"}
    rel = release_control(o, o, "orders", catalogue.config_frame(spark), run,
                          exclude_columns=["o_orderkey", "o_custkey"], quality_pass_ratio=1.0, quarantine_ratio=0.0)
    v = rel.verdict.collect()[0]
    assert (v.overall_verdict, v.gold_allowed, v.health_score) == ("PASS", True, 1.0)
    assert rel.evaluations.count() == 6 and rel.fidelity.collect()[0].row_count_ratio == 1.0
    assert rel.ledger.collect()[0].provenance_field_coverage == 1.0


def test_capture_is_idempotent_per_measurement(spark, tmp_path):
    o = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    path = str(tmp_path / "hist")
    cols = ["o_orderstatus", "o_orderpriority"]
    for _ in range(2):  # e.g. a retried load cycle
        sinks.capture_baseline({"orders": o}, path, columns=cols, measurement_ts="2024-01-01 00:00:00")
    sinks.capture_baseline({"orders": o}, path, columns=cols, measurement_ts="2024-01-02 00:00:00")
    hist = sinks.read_baselines(spark, path)
    assert hist.count() == 4 and hist.select("measurement_ts").distinct().count() == 2
    assert hist.columns == list(sinks.BASELINE_SCHEMA.fieldNames())


def test_ledger_append_and_replace(spark, tmp_path):
    runs = spark.createDataFrame(
        [("E", "r1", "s"), ("E", "r2", "s")], "experiment_id string, run_id string, status string"
    )
    led = ledger.build_ledger(runs)
    plain, replaced = str(tmp_path / "plain"), str(tmp_path / "replaced")
    for _ in range(2):
        ledger.append_ledger(led, plain)
        ledger.append_ledger(led, replaced, replace_runs=True)
    assert sinks.read(spark, plain).count() == 4  # append-only history
    assert sinks.read(spark, replaced).count() == 2  # one row per run


def test_release_many_runs_in_one_call(spark):
    from driftgate.plans.release import release_many
    from driftgate.functions import rules as R

    o = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    drifted = o.withColumn("o_orderstatus", F.lit("F"))
    ctx = {"experiment_id": "DRIFTGATE_DEMO", "git_commit": "c", "git_branch": "b", "catalog_name": "k",
           "operator": "o", "started_at_utc": "t", "status": "EXECUTION_COMPLETED"}
    rel = release_many(
        {"same": (o, o), "drifted": (o, drifted)},
        catalogue.config_frame(spark),
        [{**ctx, "run_id": "r-same", "table_name": "same"}, {**ctx, "run_id": "r-drifted", "table_name": "drifted"}],
        columns={"same": ["o_orderstatus", "o_orderpriority"], "drifted": ["o_orderstatus", "o_orderpriority"]},
        rules={"same": [R.not_null("o_orderpriority")]},  # no rules for "drifted": quality not measured
    )
    v = {r.run_id: (r.overall_verdict, r.unmeasured_gates) for r in rel.verdicts.collect()}
    assert v["r-same"] == ("PASS", [])
    assert v["r-drifted"] == ("INCOMPLETE", ["FAIL-3", "WARN-6"])
    h = {r.table_name: r.health_score for r in rel.health.collect()}
    assert h["same"] == 1.0 and h["drifted"] == 0.5
