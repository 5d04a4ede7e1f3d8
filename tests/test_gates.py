"""Gate evaluation cases (the reference's gate suite, on Spark), plus config reading."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from driftgate.operators import gates, ledger
from driftgate.plans import catalogue
from driftgate.sources import readers


def config(spark, gate_list, experiment="TEST"):
    return readers.config_from_text(spark, json.dumps({"experiment_id": experiment, "gates": gate_list}))


def g(metric, type_="FAIL", op=">=", threshold=0.7):
    return {"metric": metric, "type": type_, "op": op, "threshold": threshold, "reason": ""}


def runs(spark, run_id="r1", experiment="TEST"):
    return spark.createDataFrame([(run_id, experiment)], "run_id string, experiment_id string")


def metrics(spark, run_id="r1", **values):
    wide = spark.createDataFrame(
        [(run_id,) + tuple(values.values())],
        "run_id string" + "".join(f", {k} double" for k in values),
    )
    return gates.metrics_long(wide)


def verdict(spark, gate_list, **values):
    r = runs(spark)
    ev = gates.evaluate_gates(readers.gates_frame(config(spark, gate_list)), r, metrics(spark, **values))
    return gates.verdicts(r, ev).collect()[0], ev.orderBy("position").collect()


def test_healthy_passes(spark):
    v, ev = verdict(spark, [g("entropy_health_score")], entropy_health_score=0.92)
    assert v.overall_verdict == "PASS" and v.gold_allowed
    assert ev[0].gate_id == "FAIL-1" and ev[0].details == "0.92 >= 0.7"


def test_drifted_fails(spark):
    v, _ = verdict(spark, [g("entropy_health_score")], entropy_health_score=0.45)
    assert v.overall_verdict == "FAIL" and not v.gold_allowed


def test_missing_metric_is_incomplete(spark):
    v, ev = verdict(spark, [g("entropy_health_score")], other=1.0)
    assert v.overall_verdict == "INCOMPLETE" and v.unmeasured_gates == ["FAIL-1"]
    assert ev[0].details == "NOT_MEASURED" and ev[0].passed is None and ev[0].label == "N/A"


def test_all_pass(spark):
    gl = [g("entropy_health_score"), g("bronze_record_fidelity_ratio", threshold=0.99), g("silver_quality_pass_ratio", threshold=0.95)]
    v, ev = verdict(spark, gl, entropy_health_score=0.88, bronze_record_fidelity_ratio=1.0, silver_quality_pass_ratio=0.97)
    assert v.overall_verdict == "PASS" and all(e.passed for e in ev)


def test_entropy_failure_overrides(spark):
    gl = [g("entropy_health_score"), g("bronze_record_fidelity_ratio", threshold=0.99)]
    v, _ = verdict(spark, gl, entropy_health_score=0.35, bronze_record_fidelity_ratio=1.0)
    assert v.overall_verdict == "FAIL"


def test_warn_gate(spark):
    gl = [g("entropy_health_score"), g("entropy_columns_drifted_ratio", "WARN", "<=", 0.20)]
    v, ev = verdict(spark, gl, entropy_health_score=0.75, entropy_columns_drifted_ratio=0.3)
    assert v.overall_verdict == "WARN" and v.gold_allowed
    assert [e.label for e in ev] == ["PASS", "WARN"]


def test_no_gates_pass(spark):
    r = runs(spark)
    ev = gates.evaluate_gates(readers.gates_frame(config(spark, [])), r, metrics(spark, x=1.0), config(spark, []))
    assert gates.verdicts(r, ev).collect()[0].overall_verdict == "PASS"


def test_unknown_metric_unmeasured(spark):
    v, _ = verdict(spark, [g("no_such_metric")], entropy_health_score=0.9)
    assert v.overall_verdict == "INCOMPLETE"


def test_unknown_op_raises(spark):
    with pytest.raises((PySparkException, Py4JJavaError)):
        verdict(spark, [g("entropy_health_score", op="=>")], entropy_health_score=0.9)


def test_run_metrics_drifted_ratio_null_when_nothing_checked(spark):
    r = runs(spark)
    h = spark.createDataFrame([("r1", 0.0, 0, 0)], "run_id string, health_score double, columns_drifted int, total_columns_checked int")
    m = {x.metric: x.value for x in gates.run_metrics(r, health=h).collect()}
    assert m["entropy_health_score"] == 0.0 and m["entropy_columns_drifted_ratio"] is None


def test_config_file_defaults_and_values(spark):
    cfg = catalogue.config_frame(spark)
    th = readers.thresholds_frame(cfg).collect()[0]
    assert (th.drop_pct, th.spike_pct, th.health_floor, th.baseline_staleness_days) == (0.5, 0.5, 0.7, 30)
    assert readers.gates_frame(cfg).count() == 6
    minimal = readers.thresholds_frame(readers.config_from_text(spark, '{"gates": []}')).collect()[0]
    assert (minimal.drop_pct, minimal.health_floor, minimal.baseline_staleness_days) == (0.5, 0.7, 30)
    assert "source_system" in minimal.excluded_columns


def test_read_config_from_file(spark, tmp_path):
    p = tmp_path / "g.json"
    p.write_text(json.dumps({"experiment_id": "E", "gates": [g("entropy_health_score", threshold=1)]}, indent=2))
    gf = readers.gates_frame(readers.read_config(spark, str(p))).collect()[0]
    assert gf.threshold == 1.0 and isinstance(gf.threshold, float)


def test_provenance_coverage(spark):
    led = spark.createDataFrame(
        [("E", "r1", "c", "main", "cat", "op", "t"), ("E", "r2", "c", "", "cat", None, "t")],
        "experiment_id string, run_id string, git_commit string, git_branch string, catalog_name string, operator string, started_at_utc string",
    )
    cov = {r.run_id: r.provenance_field_coverage for r in ledger.provenance_coverage(led).collect()}
    assert cov == {"r1": 1.0, "r2": 5 / 7}


def test_other_gate_type_raises(spark):
    with pytest.raises(PySparkException, match="unknown gate type: INFO"):
        verdict(spark, [g("entropy_health_score", type_="INFO")], entropy_health_score=0.1)
