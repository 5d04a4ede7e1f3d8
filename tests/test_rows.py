"""Rules on rows with an identity, routed writes with observed counts, stored histories, gate files."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from driftgate.functions import rules as R
from driftgate.operators import bronze, compare, gates, identity, ledger, quality
from driftgate.sources import readers, sinks


def rows(spark):
    data = [(1, "a", 5.0), (1, "a", 5.0), (2, "b", -1.0), (3, "z", 2.0), (3, "z", 2.0), (4, None, 1.0), (5, "a", 3.0)]
    return identity.stored(spark.createDataFrame(data, "id int, k string, x double").repartition(3))


def known(spark):
    return spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "key string")


def test_reference_rule_keeps_multiplicity_and_order(spark):
    rules = [R.positive("x"), R.reference("k", known(spark), "key"), R.no_duplicates("k", "id")]
    out = quality.evaluate(rows(spark), rules)
    failed = sorted((r.id, r.failure_reason) for r in out.quarantine.collect())
    assert failed == [(1, "k_unique"), (2, "x_positive"), (3, "k_reference"), (3, "k_reference"), (5, "k_unique")]
    assert sorted(r.id for r in out.clean.collect()) == [1, 4]
    assert out.clean.columns == ["id", "k", "x"]
    strict = quality.evaluate(rows(spark), [R.reference("k", known(spark), "key", nulls_fail=True)])
    assert sorted(r.id for r in strict.quarantine.collect()) == [3, 3, 4]


def test_a_check_sees_only_survivors_and_may_return_a_row_twice(spark):
    def all_of_them(frame, column):
        return frame.filter(F.col(column).isNotNull()).unionByName(frame)

    out = quality.evaluate(rows(spark), [R.positive("x"), R.custom_rows("everything", "k", all_of_them), R.not_null("k")])
    counts = {r.rule_name: (r.records_failed, r.records_checked) for r in out.results.collect()}
    assert counts == {"x_positive": (1, 7), "everything": (6, 7), "k_not_null": (0, 7)}


def test_rules_on_rows_need_an_identity_and_must_keep_it(spark):
    plain = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="identity"):
        quality.evaluate(plain, [R.reference("id", plain)])
    with pytest.raises(ValueError, match="__dg_row_id"):
        quality.evaluate(identity.stored(plain), [R.custom_rows("lost", "id", lambda df, c: df.select(c))])
    with pytest.raises(ValueError, match="stored"):
        identity.identified(plain)


@pytest.mark.parametrize("limit", [100_000, 0])
def test_failing_rows_come_back_by_broadcast_or_shuffle(spark, limit, monkeypatch):
    monkeypatch.setattr(identity, "BROADCAST_ROWS", limit)
    many = identity.stored(spark.range(0, 5000, numPartitions=6).select((F.col("id") % 1000).alias("k"), "id"))
    out = quality.evaluate(many, [R.no_duplicates("k", "id")])
    clean = [r.id for r in out.clean.collect()]
    assert sorted(clean) == list(range(1000)) and out.quarantine.count() == 4000


def test_identified_and_plain_duplicates_agree(spark):
    data = spark.createDataFrame([("a", 1)] * 5 + [(None, 2)] * 3 + [("b", 1)], "k string, v int").repartition(4)
    for frame in (data, identity.stored(data)):
        out = quality.evaluate(frame, [R.no_duplicates("k")])
        assert out.clean.count() == 3 and out.quarantine.count() == 6 and out.clean_set_semantics.count() == 1


def test_route_counts_what_it_writes(spark, tmp_path):
    routed = quality.route(quality.evaluate(rows(spark), [R.positive("x"), R.no_duplicates("k", "id")], all_failures=True), str(tmp_path / "r"))
    assert routed.clean.count() == 3 and routed.quarantine.count() == 4
    assert routed.quarantine.columns == ["id", "k", "x", "all_failures", "failure_reason"]
    assert {r.rule_name: r.records_failed for r in routed.results.collect()} == {"x_positive": 1, "k_unique": 3}
    assert routed.ratios.first().quality_pass_ratio == 3 / 7 and routed.counts.first().total == 7
    none = quality.route(quality.evaluate(rows(spark).filter("id > 99"), [R.not_null("k")]), str(tmp_path / "none"))
    assert none.quarantine.count() == 0 and none.quarantine.columns == ["id", "k", "x", "failure_reason"]
    assert none.ratios.first().quality_pass_ratio is None and none.results.first().records_checked == 0


def test_history_without_its_newest_times_and_in_a_path(spark, tmp_path):
    path = str(tmp_path / "hist")
    a = spark.createDataFrame([(i, i % 3) for i in range(10)], "x int, y int")
    for ts in ("2024-01-01 23:59:59", "2024-01-02 00:00:01", "2024-01-02 00:00:01", "2024-01-01 05:00:00"):  # retried, then a late one
        sinks.capture_baseline({"t": a}, path, exclude_columns=[], measurement_ts=ts)
    sinks.capture_baseline({"u": a}, path, exclude_columns=[], measurement_ts="2024-01-01 23:59:59")
    want = {("t", "2024-01-02 00:00:01"): 2, ("u", "2024-01-01 23:59:59"): 2}

    def found(frame):
        return {(r.table_name, str(r.measurement_ts)): r["count"] for r in frame.groupBy("table_name", "measurement_ts").count().collect()}

    assert found(sinks.latest(spark, path)) == want
    assert sinks.read_baselines(spark, path).count() == 8
    assert found(sinks.latest(spark, path, "u")) == {("u", "2024-01-01 23:59:59"): 2}
    fresh = str(tmp_path / "copy")  # a history whose newest times were lost
    spark.read.parquet(path).write.partitionBy("measured_on").parquet(fresh)
    assert found(sinks.latest(spark, fresh)) == want
    sinks.capture_baseline({"v": a}, fresh, exclude_columns=[], measurement_ts="2023-01-01 00:00:00")
    assert found(sinks.latest(spark, fresh)) == want | {("v", "2023-01-01 00:00:00"): 2}


def test_ledger_replaces_single_runs_of_a_date(spark, tmp_path):
    path = str(tmp_path / "ledger")

    def record(*runs):
        frame = spark.createDataFrame([(r, s, at) for r, s, at in runs], "run_id string, status string, started_at_utc string")
        ledger.append_ledger(ledger.build_ledger(frame), path, replace_runs=True)

    record(("r1", "started", "2024-02-01T00:00:00"), ("r2", "started", "2024-02-01T09:00:00"), ("r3", "started", None))
    record(("r2", "completed", "2024-02-01T09:00:00"), ("r4", "started", "2024-02-02T00:00:00"), ("r3", "completed", None))
    got = {r.run_id: r.verdict for r in ledger.read_ledger(spark, path).collect()}
    assert got == {"r1": "started", "r2": "completed", "r3": "completed", "r4": "started"}
    assert ledger.read_ledger(spark, path).count() == 4


@pytest.mark.parametrize("op", readers.GATE_OPS)
@pytest.mark.parametrize("kind", ["FAIL", "WARN"])
def test_nan_passes_no_gate(spark, op, kind):
    doc = {"experiment_id": "E", "gates": [{"metric": "m", "type": kind, "op": op, "threshold": 0.7, "reason": ""}]}
    listed = readers.gates_frame(readers.config_from_text(spark, json.dumps(doc)))
    runs = spark.createDataFrame([("r", "E")], "run_id string, experiment_id string")
    metrics = spark.createDataFrame([("r", "m", float("nan")), ("r", "m", 0.7)], "run_id string, metric string, value double")
    ev = gates.evaluate_gates(listed, runs, metrics)
    (row,) = ev.collect()
    assert row.measured_value is None and row.passed is None and row.details == "NOT_MEASURED" and row.label == "N/A"
    v = gates.verdicts(runs, ev).first()
    assert v.overall_verdict == "INCOMPLETE" and not v.gold_allowed


def test_a_misspelt_gate_type_raises(spark):
    for kind in ("Fail", "fail", None):
        doc = {"experiment_id": "E", "gates": [{"metric": "m", "type": kind, "op": ">=", "threshold": 0.7, "reason": ""}]}
        with pytest.raises(Exception, match="unknown gate type"):
            readers.gates_frame(readers.config_from_text(spark, json.dumps(doc))).collect()


def test_folder_of_gate_files(spark, tmp_path):
    def doc(experiment, threshold):
        return {"experiment_id": experiment, "gates": [{"metric": "m", "type": "FAIL", "op": ">=", "threshold": threshold, "reason": ""}]}

    import os

    (tmp_path / "a").mkdir()
    files = {"one.json": json.dumps(doc("A", 1), indent=2), "a/two.json": json.dumps([doc("B", 1), doc("A", 2)]), "cut.json": json.dumps(doc("C", 1))[:30]}
    for i, (name, text) in enumerate(files.items()):
        (tmp_path / name).write_text(text)
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    docs = readers.read_configs(spark, str(tmp_path))
    current = readers.gates_frame(readers.current_configs(docs)).collect()
    assert {(r.experiment_id, r.threshold) for r in current} == {("A", 2.0), ("B", 1.0)}
    assert [r.source_file.rsplit("/", 1)[1] for r in readers.corrupt_configs(docs).collect()] == ["cut.json"]


def test_landing_reports_the_rows_it_wrote(spark, tmp_path):
    spark.range(7).createOrReplaceTempView("landing_src")
    schema = "landing_" + uuid.uuid4().hex[:8]
    args = {"source_system": "s", "location": str(tmp_path / "t"), "schema_location": str(tmp_path / "s")}
    reports = [bronze.materialize(spark, "landing_src", f"{schema}.t", dry_run=dry, **args).first() for dry in (True, False, False)]
    assert [(r.rows_landed, r.statements_executed) for r in reports] == [(None, 0), (7, 2), (None, 2)]
    assert {r.source_file_path for r in spark.table(f"{schema}.t").collect()} == {"landing_src"}
    assert bronze._land(spark, "landing_src", f"{schema}.t", args) is None  # came to be meanwhile


def test_comparison_others_ties_and_empty_sides(spark):
    a = spark.createDataFrame([(v,) for v in "aabbccddeeffgghhii"] + [(None,)], "v string")
    b = spark.createDataFrame([(v,) for v in "zzzyyxa"], "v string")
    got = [tuple(r) for r in compare.category_comparison(a, b, "v").orderBy("position").collect()]
    assert got == [(1, "a", 2, 1), (2, "b", 2, 0), (3, "c", 2, 0), (4, "d", 2, 0), (5, "z", 0, 3), (6, "Others", 11, 3)]
    none = a.filter("false")
    assert [tuple(r) for r in compare.category_comparison(none, b, "v").orderBy("position").collect()] == [(1, "a", 0, 1), (2, "x", 0, 1), (3, "y", 0, 2), (4, "z", 0, 3)]
    assert compare.category_comparison(none, none, "v").count() == 0
