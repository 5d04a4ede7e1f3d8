"""Profiles: golden values on a 25-row CSV pair, and the edge rows of FIXTURES.md §3."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from driftgate.operators import drift
from driftgate.operators.profile import profile, profile_tables, value_frequencies
from driftgate.sources.readers import read_csv_strings

EXCLUDED = ["employee_id", "first_name", "last_name"]
GOLDEN = {
    # column: (H baseline, Hn baseline, distinct baseline, H drifted, distinct drifted)
    "department": (1.953521, 0.976761, 4, 0.0, 1),  # 1.953521 / 2 rounded as Python does
    "hire_date": (4.643856, 1.0, 25, 4.643856, 25),
    "status": (0.402179, 0.402179, 2, 0.0, 1),
    "salary": (4.643856, 1.0, 25, 0.0, 1),
    "location": (1.582683, 0.998562, 3, 0.0, 1),
}


def by_col(df):
    return {r.column_name: r for r in df.collect()}


def test_csv_pair_golden_values(spark, employees):
    base = read_csv_strings(spark, employees[0])
    cur = read_csv_strings(spark, employees[1])
    assert base.count() == cur.count() == 25 and base.columns == cur.columns
    pb = by_col(profile(base, "employees", exclude_columns=EXCLUDED))
    pc = by_col(profile(cur, "employees", exclude_columns=EXCLUDED))
    assert set(pb) == set(GOLDEN)
    for c, (hb, hnb, db, hc, dc) in GOLDEN.items():
        assert (pb[c].entropy, pb[c].normalized_entropy, pb[c].distinct_count) == (hb, hnb, db)
        assert (pc[c].entropy, pc[c].distinct_count) == (hc, dc)
    assert pc["department"].entropy_class == "CONSTANT"
    assert pb["department"].entropy_class == "VERY_HIGH"
    h = drift.table_health(
        profile(base, "employees", exclude_columns=EXCLUDED), profile(cur, "employees", exclude_columns=EXCLUDED)
    ).collect()[0]
    assert (h.health_score, h.columns_drifted, h.total_columns_checked, h.passed_gate) == (0.2, 4, 5, False)
    same = drift.table_health(
        profile(base, "employees", exclude_columns=EXCLUDED), profile(base, "employees", exclude_columns=EXCLUDED)
    ).collect()[0]
    assert same.health_score == 1.0 and same.passed_gate


def test_entropy_matches_direct_sum(spark):
    vals = ["a"] * 7 + ["b"] * 3 + ["c"] + [None] * 4
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    r = profile(df, exclude_columns=[]).collect()[0]
    n = len(vals)
    counts = [7, 3, 1, 4]
    direct = round(-sum(c / n * math.log2(c / n) for c in counts), 6)
    assert r.entropy == direct and r.distinct_count == 4 and r.null_count == 4
    assert r.null_ratio == round(4 / 15, 4) and r.total_count == 15


def test_edge_rows(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (CAST(NULL AS STRING), 'same', 0.0D, CAST('NaN' AS DOUBLE), map('k', 1), 1, '__NULL__'),
        (CAST(NULL AS STRING), 'same', -0.0D, CAST('NaN' AS DOUBLE), map('k', 2), 2, NULL),
        (CAST(NULL AS STRING), 'same', 0.0D, 1.0D, map('k', 1), 2, NULL)
        AS t(all_null, single, zeros, nans, m, `a.b`, nullish)"""
    )
    p = by_col(profile(df, "edge", exclude_columns=[]))
    assert (p["all_null"].entropy, p["all_null"].distinct_count, p["all_null"].null_count) == (0.0, 1, 3)
    assert p["all_null"].entropy_class == "CONSTANT" and p["all_null"].null_ratio == 1.0
    assert (p["single"].entropy, p["single"].normalized_entropy, p["single"].distinct_count) == (0.0, 0.0, 1)
    assert p["zeros"].distinct_count == 1 and p["zeros"].entropy == 0.0  # -0.0 folds into 0.0
    assert p["nans"].distinct_count == 2
    assert p["m"].distinct_count == 2  # map columns profile through their string form
    assert p["a.b"].distinct_count == 2
    assert p["nullish"].distinct_count == 2 and p["nullish"].null_count == 2  # '__NULL__' is not NULL


def test_empty_table_gives_rows(spark):
    df = spark.range(10).withColumn("x", F.lit("a")).filter(F.lit(False))
    rows = profile(df, exclude_columns=[]).collect()
    assert len(rows) == 2
    assert all((r.entropy, r.distinct_count, r.total_count, r.entropy_class) == (0.0, 0, 0, "CONSTANT") for r in rows)


def test_column_selection(spark):
    df = spark.range(3).withColumns({"a": F.lit(1), "source_system": F.lit("s"), "ingest_ts": F.current_timestamp()})
    assert {r.column_name for r in profile(df).collect()} == {"id", "a"}
    assert {r.column_name for r in profile(df, exclude_columns=[]).collect()} == {"id", "a", "source_system", "ingest_ts"}
    assert {r.column_name for r in profile(df, columns=["a", "source_system"]).collect()} == {"a"}


def test_long_values_fingerprinted_exactly(spark):
    long_a, long_b = "x" * 500, "x" * 499 + "y"
    df = spark.createDataFrame([(long_a,), (long_a,), (long_b,), ("short",)], "v string")
    r = profile(df, exclude_columns=[]).collect()[0]
    assert r.distinct_count == 3
    assert r.entropy == round(-(0.5 * math.log2(0.5) + 2 * 0.25 * math.log2(0.25)), 6)


def test_many_tables(spark):
    a = spark.range(4).withColumn("k", F.col("id") % 2)
    b = spark.range(8).withColumn("k", F.lit(1))
    out = {(r.table_name, r.column_name): r.distinct_count for r in profile_tables({"a": a, "b": b}, exclude_columns=[]).collect()}
    assert out == {("a", "id"): 4, ("a", "k"): 2, ("b", "id"): 8, ("b", "k"): 1}


def test_value_frequencies(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    got = {(r.value, r.frequency) for r in value_frequencies(df).collect()}
    assert got == {("a", 2), (None, 1)}
