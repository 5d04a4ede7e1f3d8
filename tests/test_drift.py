"""Drift and health cases (the reference's drift suite, on Spark)."""

from __future__ import annotations

import pytest

from driftgate.operators import drift


def prof(spark, rows, table="t"):
    return spark.createDataFrame([(table, c, float(h)) for c, h in rows], "table_name string, column_name string, entropy double")


def one(spark, b, c, **kw):
    d = drift.column_drift(prof(spark, [("x", b)]), prof(spark, [("x", c)]), **kw)
    return d.collect()[0]


@pytest.mark.parametrize(
    "b,c,direction,detected",
    [
        (3.2, 3.1, "STABLE", False),
        (3.2, 1.0, "COLLAPSE", True),
        (2.0, 3.5, "SPIKE", True),
        (0.0, 0.0, "STABLE", False),
        (0.0, 2.5, "SPIKE", True),
        (3.0, 1.5, "STABLE", False),  # exactly -50 %: strict comparison
    ],
)
def test_column_drift_cases(spark, b, c, direction, detected):
    r = one(spark, b, c)
    assert r.drift_direction == direction
    assert r.drift_detected is detected


def test_column_drift_scores(spark):
    assert one(spark, 3.2, 3.1).stability_score > 0.9
    r = one(spark, 0.0, 0.0)
    assert (r.drift_magnitude, r.stability_score) == (0.0, 1.0)
    r = one(spark, 0.0, 2.5)
    assert (r.drift_magnitude, r.stability_score) == (1.0, 0.0)


def test_custom_thresholds(spark):
    assert one(spark, 5.0, 4.0, drop_pct=0.10, spike_pct=0.10).drift_detected
    assert not one(spark, 5.0, 3.0, drop_pct=0.80, spike_pct=0.80).drift_detected


def health(spark, base, cur, **kw):
    return drift.table_health(prof(spark, base), prof(spark, cur), **kw).collect()[0]


BASE = [("id", 10.0), ("status", 2.5), ("amount", 8.0)]


def test_healthy_table(spark):
    h = health(spark, BASE, [("id", 9.8), ("status", 2.4), ("amount", 7.9)])
    assert h.passed_gate and h.health_score > 0.90 and h.columns_drifted == 0


def test_drifted_table(spark):
    h = health(spark, BASE, [("id", 10.0), ("status", 0.1), ("amount", 0.5)])
    assert not h.passed_gate and h.health_score < 0.70 and h.columns_drifted == 2
    assert [f.column_name for f in h.flagged_columns] == ["amount", "status"]
    assert [d.column_name for d in h.column_details] == ["amount", "id", "status"]


def test_one_of_four(spark):
    base = [(c, 5.0) for c in "abcd"]
    h = health(spark, base, [("a", 5.0), ("b", 5.0), ("c", 0.1), ("d", 5.0)])
    assert h.columns_drifted == 1 and h.health_score >= 0.70


def test_no_common_columns(spark):
    h = health(spark, [("x", 5.0)], [("y", 5.0)])
    assert (h.health_score, h.passed_gate, h.total_columns_checked) == (0.0, False, 0)
    assert h.flagged_columns == [] and h.column_details == []


def test_weights_lower_score(spark):
    base, cur = [("revenue", 8.0), ("notes", 6.0)], [("revenue", 1.0), ("notes", 6.0)]
    plain = health(spark, base, cur)
    weighted = health(spark, base, cur, weights={"revenue": 3.0, "notes": 1.0})
    assert weighted.health_score < plain.health_score


def test_weights_of_absent_columns_do_not_count(spark):
    base, cur = [("a", 4.0)], [("a", 4.0)]
    assert health(spark, base, cur, weights={"zzz": 100.0}).health_score == 1.0


def test_many_tables_one_job(spark):
    b = prof(spark, [("a", 4.0)], "t1").unionByName(prof(spark, [("a", 4.0)], "t2"))
    c = prof(spark, [("a", 4.0)], "t1").unionByName(prof(spark, [("a", 0.0)], "t2"))
    out = {r.table_name: r.health_score for r in drift.table_health(b, c).collect()}
    assert out == {"t1": 1.0, "t2": 0.0}


def test_unmatched_and_ratio(spark):
    b = prof(spark, [("a", 1.0), ("b", 1.0)])
    c = prof(spark, [("a", 1.0), ("c", 1.0)])
    rows = {(r.column_name, r.side) for r in drift.unmatched_columns(b, c).collect()}
    assert rows == {("b", "baseline_only"), ("c", "current_only")}
    h = drift.table_health(prof(spark, [("x", 1.0)], "t"), prof(spark, [("y", 1.0)], "t"))
    assert drift.drifted_ratio(h).collect()[0].drifted_ratio is None


def test_unrounded_composite(spark):
    base, cur = [("a", 3.0), ("b", 3.0), ("c", 3.0)], [("a", 2.0), ("b", 3.0), ("c", 3.0)]
    h = drift.table_health(prof(spark, base), prof(spark, cur), rounded=False).collect()[0]
    assert h.health_score == pytest.approx((2 / 3 + 1 + 1) / 3, abs=1e-12) and h.health_score != round(h.health_score, 4)


def test_health_history_scores_every_load(spark):
    base = prof(spark, [("a", 4.0), ("b", 2.0)])
    hist = spark.createDataFrame(
        [
            ("t", "2024-01-01", "a", 4.0), ("t", "2024-01-01", "b", 2.0),
            ("t", "2024-01-02", "a", 0.0), ("t", "2024-01-02", "b", 2.0),
            ("t", "2024-01-03", "zzz", 1.0),
        ],
        "table_name string, measurement_ts string, column_name string, entropy double",
    )
    got = {r.measurement_ts: (r.health_score, r.columns_drifted, r.total_columns_checked) for r in drift.health_history(base, hist).collect()}
    assert got == {"2024-01-01": (1.0, 0, 2), "2024-01-02": (0.5, 1, 2), "2024-01-03": (0.0, 0, 0)}
