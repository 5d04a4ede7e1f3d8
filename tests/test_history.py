"""Histories in catalog tables, gates that must not be passed by, and zone-free keys."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest

from driftgate.functions.entropy import category_key
from driftgate.operators.gates import evaluate_gates, verdicts
from driftgate.operators.profile import profile
from driftgate.sources import sinks
from driftgate.sources.readers import config_from_text, gates_frame

GATES = "run_id string, experiment_id string, table_name string"


@pytest.fixture()
def table(spark, tmp_path):
    name = f"hist_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_captures_into_a_catalog_table_keep_the_history(spark, table):
    a = spark.createDataFrame([(i, i % 3) for i in range(10)], "x int, y int")
    sinks.capture_baseline({"orders": a}, table, exclude_columns=[], measurement_ts="2024-01-01 00:00:00")
    sinks.capture_baseline({"orders": a}, table, exclude_columns=[], measurement_ts="2024-02-01 00:00:00")
    sinks.capture_baseline({"customer": a}, table, exclude_columns=[], measurement_ts="2024-03-01 00:00:00")
    sinks.capture_baseline({"customer": a}, table, exclude_columns=[], measurement_ts="2024-03-01 00:00:00")  # a retry
    rows = sinks.read_baselines(spark, table).collect()
    assert sorted((r.table_name, r.measurement_ts.month) for r in rows) == [("customer", 3)] * 2 + [("orders", 1)] * 2 + [("orders", 2)] * 2


def test_stored_time_does_not_depend_on_the_zone(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    path, zone = str(tmp_path / "h"), spark.conf.get("spark.sql.session.timeZone")
    when = dt.datetime(2024, 7, 1, 12, tzinfo=dt.timezone.utc)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        sinks.capture_baseline({"t": df}, path, exclude_columns=[], measurement_ts=when)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        got = sinks.read_baselines(spark, path).selectExpr("unix_micros(measurement_ts) AS us").first().us
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == int(when.timestamp()) * 1_000_000


def gate_rows(spark, text):
    config = config_from_text(spark, text)
    return config, gates_frame(config)


CONFIG = '{"experiment_id": "E", "gates": [{"metric": "entropy_health_score", "type": "FAIL", "op": ">=", "threshold": 0.7, "reason": "r"}]}'


def test_a_run_without_its_gates_does_not_pass(spark):
    config, gates = gate_rows(spark, CONFIG)
    runs = spark.createDataFrame([("a", "E", "t"), ("b", "other", "t"), ("c", None, "t")], GATES)
    metrics = spark.createDataFrame([(r, "entropy_health_score", 0.9) for r in "abc"], "run_id string, metric string, value double")
    got = {r.run_id: (r.overall_verdict, r.gold_allowed, r.gates_evaluated) for r in verdicts(runs, evaluate_gates(gates, runs, metrics, config)).collect()}
    assert got == {"a": ("PASS", True, 1), "b": ("INCOMPLETE", False, 0), "c": ("INCOMPLETE", False, 0)}


def test_an_experiment_that_lists_no_gates_passes(spark):
    config, gates = gate_rows(spark, '{"experiment_id": "E", "gates": []}')
    runs = spark.createDataFrame([("a", "E", "t"), ("b", "F", "t")], GATES)
    metrics = spark.createDataFrame([], "run_id string, metric string, value double")
    got = {r.run_id: r.overall_verdict for r in verdicts(runs, evaluate_gates(gates, runs, metrics, config)).collect()}
    assert got == {"a": "PASS", "b": "INCOMPLETE"}


def test_a_gate_over_two_tables_counts_once_at_its_worst(spark):
    config, gates = gate_rows(spark, CONFIG)
    runs = spark.createDataFrame([("a", "E", "t")], GATES)
    metrics = spark.createDataFrame([("a", "entropy_health_score", 0.9), ("a", "entropy_health_score", 0.2)], "run_id string, metric string, value double")
    rows = evaluate_gates(gates, runs, metrics, config)
    assert [(r.passed, r.measured_value) for r in rows.collect()] == [(False, 0.2)]
    assert verdicts(runs, rows).first().overall_verdict == "FAIL"


def test_keys_of_nested_values_and_zone_free_times(spark):
    arrays = spark.sql("SELECT explode(array(array('a, b'), array('a', 'b'), array('null'), array(CAST(NULL AS STRING)))) AS v")
    assert arrays.select(category_key("v", arrays.schema["v"].dataType)).distinct().count() == 4
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ntz = spark.sql("SELECT explode(array(TIMESTAMP_NTZ'2024-03-10 02:30:00', TIMESTAMP_NTZ'2024-03-10 03:30:00', TIMESTAMP_NTZ'1960-01-01 00:00:00.000001')) AS v")
        assert profile(ntz, "t", exclude_columns=[]).first().distinct_count == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
