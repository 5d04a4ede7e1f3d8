"""Catalogue, part 3: rules that compare rows, outcomes without failures, catalog tables, gate files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftgate.functions import rules as R
from driftgate.operators import bronze, drift, gates, quality
from driftgate.operators.identity import identified, stored
from driftgate.operators.profile import profile
from driftgate.plans import fixtures as fx
from driftgate.plans import oracle as O
from driftgate.plans.catalogue import _bronze, _orders_profiles, _orders_profiles_sql, _r6
from driftgate.plans.catalogue_runs import Scenario, _scenario_sql
from driftgate.session import scratch_path
from driftgate.sources import readers

# ============================================================================ rules on rows (QR5)

#: Customers that the reference check knows: every 13th is missing.
KNOWN_CUSTOMERS = "c_custkey % 13 <> 0"
ORDER_RULES = ("o_totalprice_positive", "o_custkey_reference", "o_orderpriority_not_null")


def q_rule_reference(spark, sf):
    """Orders whose customer is not known, as one rule among others; every order twice, so that
    multiplicity shows, and so the rows are stored once to have an identity."""
    orders = fx.orders_nulls(spark, sf)
    known = fx.table(spark, sf, "customer").filter(KNOWN_CUSTOMERS)
    rules = [
        R.custom(ORDER_RULES[0], "o_totalprice", lambda c: F.col(c) > 200000),
        R.reference("o_custkey", known, "c_custkey"),
        R.not_null("o_orderpriority"),
    ]
    out = quality.evaluate(stored(orders.unionByName(orders), "orders_twice"), rules)
    return out.quarantine.select("o_orderkey", "o_custkey", "failure_reason")


def sql_rule_reference():
    reason = (
        f"CASE WHEN o_totalprice > 200000 THEN '{ORDER_RULES[0]}' "
        f"WHEN o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE {KNOWN_CUSTOMERS}) THEN '{ORDER_RULES[1]}' "
        f"WHEN o_orderpriority IS NULL THEN '{ORDER_RULES[2]}' END"
    )
    one = f"SELECT o_orderkey, o_custkey, {reason} AS failure_reason FROM ({O.ORDERS_NULLS})"
    return f"SELECT * FROM ({one} UNION ALL {one}) WHERE failure_reason IS NOT NULL"


def q_rule_rows(spark, sf):
    """A user's own check that returns rows: line items dearer than their whole order."""

    def dearer_than_order(items, column):
        orders = fx.orders(spark, sf).select("o_orderkey", "o_totalprice")
        joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.filter(F.col(column) > F.col("o_totalprice"))

    rules = [R.custom("returned", "l_returnflag", lambda c: F.col(c) == "R"), R.custom_rows("dearer_than_order", "l_extendedprice", dearer_than_order)]
    out = quality.evaluate(identified(fx.table(spark, sf, "lineitem")), rules)
    return out.results


def sql_rule_rows():
    dear = "l_returnflag <> 'R' AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND l_extendedprice > o_totalprice)"
    rows = [("1", "returned", "l_returnflag", "l_returnflag = 'R'"), ("2", "dearer_than_order", "l_extendedprice", dear)]
    counted = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS rule_position, '{n}' AS rule_name, '{c}' AS column_name, count(*) AS total, count(*) FILTER ({p}) AS failed FROM lineitem"
        for i, n, c, p in rows
    )
    return (
        "SELECT rule_position, rule_name, column_name, failed = 0 AS passed, CAST(total AS BIGINT) AS records_checked, "
        f"CAST(failed AS BIGINT) AS records_failed, {O.rnd('failed / total', 4)} AS failure_ratio, "
        f"CASE WHEN failed > 0 THEN 'QUARANTINE' ELSE 'NONE' END AS action_taken FROM ({counted})"
    )


def q_quality_quarantine_empty(spark, sf):
    """A load that no rule objects to: the quarantine is empty and keeps its columns (PRJ7)."""
    out = quality.evaluate(identified(fx.orders(spark, sf)), [R.not_null("o_orderkey"), R.no_duplicates("o_orderkey")])
    return quality.route(out, scratch_path(spark, "routed")).quarantine


def sql_quality_quarantine_empty():
    return "SELECT *, 'none' AS failure_reason FROM orders WHERE o_orderkey IS NULL"


# ============================================================================ catalog tables (SRC2)

def q_catalog_profile(spark, sf):
    """The profile of a landed catalog table, read by its name; lineage columns are left out."""
    view, target, args = _bronze(spark, sf, "part")
    bronze.materialize(spark, view, target, **args)
    return profile(readers.read_table(spark, target), "part")


def sql_catalog_profile():
    return O.profile("part", "SELECT * FROM part", O.PART_COLS)


# ============================================================================ health, unrounded (AGG10)

def q_table_health_unrounded(spark, sf):
    h = drift.table_health(*_orders_profiles(spark, sf), weights={"o_orderpriority": 3.0, "o_orderdate": 0.7}, rounded=False)
    return h.select("table_name", F.round("health_score", 9).alias("health_score"), F.col("health_score").cast("decimal(5,4)").cast("double").alias("rounded"))


def sql_table_health_unrounded():
    w = "CASE column_name WHEN 'o_orderpriority' THEN 3.0::DOUBLE WHEN 'o_orderdate' THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END"
    mean = f"sum(stability_score * {w}) / sum({w})"
    d = O.drift(*_orders_profiles_sql())
    return f"SELECT table_name, round({mean}, 9) AS health_score, round({mean}, 4) AS rounded FROM ({d}) GROUP BY table_name"


# ============================================================================ gates

def q_gate_details(spark, sf):
    """The details text of every gate (SCL5), taken apart again: value, comparison, threshold."""
    parts = F.split("details", " ")
    text = Scenario(spark, sf).evaluations.select("run_id", "gate_id", "details", parts.alias("p"))
    measured = F.col("details") != "NOT_MEASURED"
    return text.select(
        "run_id", "gate_id", F.when(~measured, F.col("details")).alias("not_measured"), F.size("p").alias("words"),
        F.when(measured, F.round(F.get("p", F.lit(0)).cast("double"), 6)).alias("value"),
        F.when(measured, F.concat_ws(" ", F.get("p", F.lit(1)), F.get("p", F.lit(2)))).alias("comparison"),
    )


def sql_gate_details():
    return _scenario_sql(
        "SELECT run_id, gate_id, CASE WHEN measured_value IS NULL THEN 'NOT_MEASURED' END AS not_measured, "
        "CAST(CASE WHEN measured_value IS NULL THEN 1 ELSE 3 END AS INTEGER) AS words, round(measured_value, 6) AS value, "
        "CASE WHEN measured_value IS NOT NULL THEN op || ' ' || CAST(CAST(threshold AS DOUBLE) AS VARCHAR) END AS comparison FROM evals"
    )


OPS = readers.GATE_OPS


def q_gate_nan(spark, sf):
    """One run a market segment and balance sign, a gate per comparison, and a metric that is not a number for
    the runs without a balance in the segment's upper half: such a run cannot be published."""
    c = fx.table(spark, sf, "customer")
    runs = c.groupBy(F.concat_ws("-", "c_mktsegment", F.signum("c_acctbal").cast("int")).alias("run_id")).agg(
        F.max("c_acctbal").alias("top"), F.avg("c_acctbal").alias("mean")
    )
    value = F.when(F.col("top") > 0, F.round("mean", 2)).otherwise(F.lit(float("nan")))
    metrics = runs.select("run_id", F.lit("mean_balance").alias("metric"), value.alias("value"))
    listed = ", ".join(f"('E', {i}, 'FAIL-{i}', 'mean_balance', 'FAIL', '{op}', 100.0D)" for i, op in enumerate(OPS, start=1))
    gate_rows = spark.sql(f"SELECT * FROM VALUES {listed} AS g(experiment_id, position, gate_id, metric, gate_type, op, threshold)")
    run_rows = runs.select("run_id", F.lit("E").alias("experiment_id"))
    rows = gates.evaluate_gates(gate_rows, run_rows, metrics)
    verdict = gates.verdicts(run_rows, rows).select("run_id", "overall_verdict", "gold_allowed")
    return rows.select("run_id", "gate_id", "measured_value", "passed", "label").join(verdict, "run_id")


def sql_gate_nan():
    listed = ", ".join(f"({i}, '{op}')" for i, op in enumerate(OPS, start=1))
    passed = (
        "CASE op WHEN '>=' THEN v >= 100 WHEN '<=' THEN v <= 100 WHEN '>' THEN v > 100 WHEN '<' THEN v < 100 ELSE v = 100 END"
    )
    return (
        "WITH r AS (SELECT c_mktsegment || '-' || CAST(sign(c_acctbal) AS INTEGER) AS run_id, "
        "CASE WHEN max(c_acctbal) > 0 THEN round(avg(c_acctbal), 2) END AS v FROM customer GROUP BY 1), "
        f"e AS (SELECT run_id, 'FAIL-' || i AS gate_id, v AS measured_value, {passed} AS passed FROM r, (VALUES {listed}) AS g(i, op)) "
        "SELECT *, CASE WHEN passed THEN 'PASS' WHEN NOT passed THEN 'FAIL' ELSE 'N/A' END AS label, "
        "CASE WHEN bool_or(measured_value IS NULL) OVER w THEN 'INCOMPLETE' WHEN bool_or(NOT passed) OVER w THEN 'FAIL' ELSE 'PASS' END AS overall_verdict, "
        "NOT (bool_or(measured_value IS NULL) OVER w OR bool_or(NOT passed) OVER w) AS gold_allowed FROM e WINDOW w AS (PARTITION BY run_id)"
    )


def q_gate_files(spark, sf):
    """A folder of gate files (SRC3), one document a customer, some written again later, some cut off:
    every customer's orders against the gate of the newest document; a cut-off one leaves its customer unmatched."""
    folder = scratch_path(spark, "gate_files")
    c = fx.table(spark, sf, "customer").select("c_custkey", "c_acctbal")

    def documents(rows, kind: str):
        gate = F.struct(
            F.lit("spent").alias("metric"), F.lit(kind).alias("type"), F.lit("<=").alias("op"),
            F.round(F.abs("c_acctbal") * 100, 2).alias("threshold"), F.lit("spending limit").alias("reason"),
        )
        doc = F.to_json(F.struct(F.concat(F.lit("customer-"), F.col("c_custkey")).alias("experiment_id"), F.array(gate).alias("gates")))
        cut = F.expr("c_custkey % 50 = 7")
        return rows.select(F.when(cut, F.substring(doc, 1, 40)).otherwise(doc).alias("value"))

    documents(c, "FAIL").write.text(folder + "/a")
    documents(c.filter("c_custkey % 3 = 0"), "WARN").write.text(folder + "/b")
    config = readers.current_configs(readers.read_configs(spark, folder, lines=True))
    spent = fx.orders(spark, sf).groupBy("o_custkey").agg(F.sum("o_totalprice").alias("value"))
    runs = spent.select(F.col("o_custkey").cast("string").alias("run_id"), F.concat(F.lit("customer-"), F.col("o_custkey")).alias("experiment_id"))
    metrics = spent.select(F.col("o_custkey").cast("string").alias("run_id"), F.lit("spent").alias("metric"), "value")
    rows = gates.evaluate_gates(readers.gates_frame(config), runs, metrics, config)
    return _r6(rows.select("run_id", "gate_id", "threshold", "passed", "label"), "threshold")


def sql_gate_files():
    return (
        "WITH spent AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders GROUP BY 1), "
        "doc AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'WARN' ELSE 'FAIL' END AS t, round(abs(c_acctbal) * 100, 2) AS threshold "
        "FROM customer WHERE c_custkey % 50 <> 7) "
        "SELECT CAST(o_custkey AS VARCHAR) AS run_id, coalesce(t || '-1', 'UNMATCHED') AS gate_id, round(threshold, 6) AS threshold, "
        "v <= threshold AS passed, CASE WHEN threshold IS NULL THEN 'N/A' WHEN v <= threshold THEN 'PASS' ELSE t END AS label "
        "FROM spent LEFT JOIN doc ON c_custkey = o_custkey"
    )
