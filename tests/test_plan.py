"""Plan shape: one scan and two exchanges per profile, pruning and pushdown reach the scan."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from driftgate.functions import rules as R
from driftgate.operators import quality
from driftgate.operators.identity import identified
from driftgate.operators.profile import profile
from driftgate.sources import sinks


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_is_one_scan_two_exchanges(spark):
    orders = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    p = plan_of(profile(orders, "orders", columns=["o_orderstatus", "o_orderpriority"]))
    assert p.count("FileScan parquet") == 1
    assert p.count("Exchange hashpartitioning") == 2
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in p
    assert "Window" not in p and "PythonUDF" not in p and "BatchEvalPython" not in p


def jobs_of(spark, build) -> int:
    """Spark jobs that ``build`` starts."""
    sc, group = spark.sparkContext, "build-only"
    sc.setJobGroup(group, group)
    try:
        build()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_nothing_runs_while_building(spark):
    orders = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    items = spark.read.parquet(os.path.join(SF_SMALL, "lineitem.parquet"))
    joined = orders.join(items, orders["o_orderkey"] == items["l_orderkey"])
    counts = joined.groupBy("o_custkey", "o_orderstatus").agg(F.sum("l_quantity").alias("q"))
    narrow = orders.join(F.broadcast(items.limit(10).select("l_orderkey")), orders["o_orderkey"] == items["l_orderkey"])
    two = [R.no_duplicates("o_orderkey", "o_orderkey"), R.no_duplicates("o_custkey", "o_orderkey")]
    assert jobs_of(spark, lambda: profile(counts, "t")) == 0
    assert jobs_of(spark, lambda: quality.evaluate(narrow, two)) == 0
    assert jobs_of(spark, lambda: quality.evaluate(joined, two).clean) == 0
    assert jobs_of(spark, lambda: orders.count()) > 0


def test_latest_reads_one_date_of_a_catalog_history(spark, tmp_path):
    orders = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    schema = "hist_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/{schema}'")
    target = f"{schema}.baselines"
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        sinks.capture_baseline({"orders": orders, "other": orders}, target, exclude_columns=[], measurement_ts=f"{day} 00:00:00")
        sinks.capture_baseline({"orders": orders}, target, exclude_columns=[], measurement_ts=f"{day} 01:00:00")
    latest = sinks.latest(spark, target, "orders")
    p = plan_of(latest)
    assert "PartitionFilters: [isnotnull(measured_on" in p and "2024-01-03" in p and "2024-01-02" not in p
    assert {(r.table_name, str(r.measurement_ts)) for r in latest.collect()} == {("orders", "2024-01-03 01:00:00")}
    folders = [f for f in os.listdir(f"{tmp_path}/{schema}/baselines") if f.startswith("measured_on=")]
    assert len(folders) == 3  # a folder a day, not a measurement


def test_identified_duplicates_shuffle_no_text(spark):
    docs = identified(spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet")))
    ids = quality._failing_ids(docs.withColumn("_rule_pos", F.lit(None).cast("int")), R.no_duplicates("text", "doc_id"))
    out = quality.evaluate(docs, [R.no_duplicates("text", "doc_id")])
    p = plan_of(out.tagged)
    assert "hashpartitioning" not in p and "BroadcastExchange" in p  # the rows themselves stay where they are
    assert ids.columns == ["__dg_row_id"] and 0 < ids.count() == out.quarantine.count()
    thin = quality._losers(docs.select("__dg_row_id", quality._dup_key(docs, ["text"]).alias("_dk"), "doc_id"), F.lit(True), ["doc_id"])[0]
    for line in plan_of(thin).splitlines():
        if "Exchange" in line or "Window" in line:
            assert "text" not in line


def test_routed_write_scans_once(spark, tmp_path):
    docs = identified(spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet")))
    out = quality.evaluate(docs, [R.custom("short", "n_chars", lambda c: F.col(c) < 200)])
    assert plan_of(out.tagged).count("FileScan") == 1
    routed = quality.route(out, str(tmp_path / "routed"))
    for side in (routed.results, routed.ratios):
        assert "FileScan" not in plan_of(side)  # observed by the write
    p = plan_of(routed.quarantine)
    assert "PartitionFilters: [isnotnull(route" in p


def test_duplicate_rule_has_no_window_over_the_bare_key(spark):
    docs = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet"))
    p = plan_of(quality.evaluate(docs, [R.no_duplicates("text", "doc_id")]).tagged)
    assert "hashpartitioning(_dk" in p and "_sp" in p and "Join" not in p
    assert "sha2" in p  # keys are digests
