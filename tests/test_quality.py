"""Quality engine: routing, attribution order, duplicates, set semantics."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from driftgate.functions import rules as R
from driftgate.operators import quality


def frame(spark):
    return spark.createDataFrame(
        [
            (1, "a", 10.0, "2020-01-01"),
            (2, "a", -1.0, "2020-01-02"),
            (3, None, 5.0, "2020-01-03"),
            (4, "b", 5.0, "2008-12-31"),
            (5, "b", 5.0, "2020-01-05"),
            (6, "b", 5.0, "2020-01-05"),
        ],
        "id int, k string, x double, d string",
    ).withColumn("d", F.col("d").cast("date"))


def test_first_failing_rule_wins_and_counts(spark):
    rules = [R.not_null("k"), R.positive("x"), R.valid_date_range("d", as_of="2021-01-01"), R.no_duplicates("k", "id")]
    out = quality.evaluate(frame(spark), rules)
    reasons = {r.id: r.failure_reason for r in out.tagged.collect()}
    assert reasons == {1: None, 2: "x_positive", 3: "k_not_null", 4: "d_date_range", 5: None, 6: "k_unique"}
    res = {r.rule_name: (r.records_failed, r.records_checked, r.passed, r.action_taken) for r in out.results.collect()}
    assert res["k_not_null"] == (1, 6, False, "QUARANTINE")
    assert res["k_unique"] == (1, 6, False, "QUARANTINE")
    assert out.clean.count() + out.quarantine.count() == 6
    ratios = out.ratios.collect()[0]
    assert ratios.quality_pass_ratio == 2 / 6 and ratios.quarantine_ratio == 4 / 6


def test_duplicates_only_among_survivors(spark):
    # id 2 fails the first rule, so id 3 is the first survivor of key 'a'... order by id
    df = spark.createDataFrame([(1, "a", -1.0), (2, "a", 1.0), (3, "a", 1.0)], "id int, k string, x double")
    out = quality.evaluate(df, [R.positive("x"), R.no_duplicates("k", "id")])
    reasons = {r.id: r.failure_reason for r in out.tagged.collect()}
    assert reasons == {1: "x_positive", 2: None, 3: "k_unique"}


def test_identical_rows_keep_one_copy(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [(None, 2)] * 3, "k string, v int").repartition(4)
    out = quality.evaluate(df, [R.no_duplicates("k")])
    assert out.clean.count() == 2  # one per key, NULL keys are one group
    assert out.quarantine.count() == 6
    assert out.clean_set_semantics.count() == 0  # EXCEPT DISTINCT drops every copy


def test_hot_key_spread_over_partitions(spark):
    hot = spark.range(0, 20000, numPartitions=8).select(F.lit("hot").alias("k"), F.col("id"))
    out = quality.evaluate(hot, [R.no_duplicates("k", "id")])
    clean = out.clean.collect()
    assert len(clean) == 1 and clean[0].id == 0
    assert out.quarantine.count() == 19999


def test_empty_input(spark):
    df = frame(spark).filter(F.lit(False))
    out = quality.evaluate(df, [R.not_null("k")])
    r = out.results.collect()[0]
    assert (r.records_checked, r.records_failed, r.failure_ratio, r.action_taken) == (0, 0, 0.0, "NONE")
    assert out.quarantine.columns == df.columns + ["failure_reason"]
    assert out.ratios.collect()[0].quality_pass_ratio is None


def test_union_of_quarantines(spark):
    a = spark.createDataFrame([(1, None)], "id int, k string")
    b = spark.createDataFrame([(None, 2.0)], "name string, x double")
    qa = quality.evaluate(a, [R.not_null("k")]).quarantine
    qb = quality.evaluate(b, [R.not_null("name")]).quarantine
    u = quality.union_quarantine([qa, qb])
    assert set(u.columns) == {"id", "k", "name", "x", "failure_reason"} and u.count() == 2


def test_write_routed(spark, tmp_path):
    out = quality.evaluate(frame(spark), [R.not_null("k"), R.positive("x")])
    path = str(tmp_path / "routed")
    quality.write_routed(out, path)
    back = spark.read.parquet(path)
    assert back.filter("route = 'quarantine'").count() == 2 and back.filter("route = 'clean'").count() == 4


def test_rule_validation():
    with pytest.raises(ValueError):
        R.Rule("r", "c", lambda c: None, action="DROP")


def test_all_failures_lists_every_row_rule(spark):
    rules = [R.not_null("k"), R.positive("x"), R.valid_date_range("d", as_of="2021-01-01")]
    df = spark.createDataFrame([(1, None, -1.0, None)], "id int, k string, x double, d date")
    q = quality.evaluate(df, rules, all_failures=True).quarantine.collect()[0]
    assert q.failure_reason == "k_not_null"
    assert q.all_failures == ["k_not_null", "x_positive", "d_date_range"]
