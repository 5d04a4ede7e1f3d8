"""Catalogue, part 2: gates, verdicts, ledger, category comparison, simulation, release.

The multi-run scenario evaluates four loads (orders, customer, part, events) as four runs
of one experiment in one set of jobs; every metric is measured from the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.functions import rules as R
from driftgate.operators import compare, ledger, quality, simulate
from driftgate.plans import fixtures as fx
from driftgate.plans import oracle as O
from driftgate.plans.catalogue import LOADS, ORDER_KEYS, _many_profiles_sql, _r6, config_frame
from driftgate.plans.release import release_control, release_stored
from driftgate.session import materialize_small, scratch_path
from driftgate.sources import sinks

EXPERIMENT = "DRIFTGATE_DEMO"
_CTX = dict(
    experiment_id=EXPERIMENT, git_commit="a1b2c3d", git_branch="main", catalog_name="dev",
    operator="scheduler", started_at_utc="2024-02-01T00:00:00+00:00",
    completed_at_utc="2024-02-01T00:10:00+00:00", status="EXECUTION_COMPLETED",
)
RUNS = [
    {**_CTX, "run_id": "run-orders", "table_name": "orders"},
    {**_CTX, "run_id": "run-customer", "table_name": "customer", "git_branch": ""},
    {**_CTX, "run_id": "run-part", "table_name": "part", "operator": None},
    {**_CTX, "run_id": "run-events", "table_name": "events"},
]
# Row rules per table; part has none, so its quality gates are not measured.
RUN_RULES = {
    "orders": [R.not_null("o_orderpriority")],
    "customer": [R.not_null("c_nationkey"), R.positive("c_acctbal")],
    "events": [R.positive("value")],
}
RUN_RULES_SQL = {
    "orders": "o_orderpriority IS NULL",
    "customer": "c_nationkey IS NULL OR c_acctbal IS NULL OR c_acctbal <= 0",
    "events": "value IS NULL OR value <= 0",
}
GATES_SQL = (
    "SELECT * FROM (VALUES (1, 'FAIL-1', 'entropy_health_score', 'FAIL', '>=', 0.70), "
    "(2, 'FAIL-2', 'bronze_record_fidelity_ratio', 'FAIL', '>=', 0.99), "
    "(3, 'FAIL-3', 'silver_quality_pass_ratio', 'FAIL', '>=', 0.95), "
    "(4, 'FAIL-4', 'provenance_field_coverage', 'FAIL', '>=', 1.0), "
    "(5, 'WARN-5', 'entropy_columns_drifted_ratio', 'WARN', '<=', 0.20), "
    "(6, 'WARN-6', 'silver_quarantine_ratio', 'WARN', '<=', 0.10)) "
    "AS g(position, gate_id, metric, gate_type, op, threshold)"
)


class Scenario:
    """Frames of the multi-run scenario: four baselines captured in a history, then the four
    new loads released against it (``plans.release.release_stored``)."""

    def __init__(self, spark: SparkSession, sf: str):
        columns = {t: v[2] for t, v in LOADS.items()}
        target = scratch_path(spark, "scenario-baselines")
        sinks.capture_baseline({t: v[0](spark, sf) for t, v in LOADS.items()}, target, columns)
        rel = release_stored(
            sinks.read_baselines(spark, target),
            {t: v[1](spark, sf) for t, v in LOADS.items()},
            config_frame(spark),
            RUNS,
            columns=columns,
            rules=RUN_RULES,
        )
        self.ledger = rel.ledger
        self.evaluations = rel.evaluations
        self.verdicts = rel.verdicts


def _runs_sql() -> str:
    def v(x):
        return "NULL" if x is None else O.q(x)

    rows = ", ".join(
        "(" + ", ".join(v(r.get(f)) for f in (
            "run_id", "table_name", "experiment_id", "git_commit", "git_branch", "catalog_name",
            "operator", "started_at_utc", "completed_at_utc", "status",
        )) + ")"
        for r in RUNS
    )
    return (
        f"SELECT * FROM (VALUES {rows}) AS r(run_id, table_name, experiment_id, git_commit, git_branch, "
        "catalog_name, operator, started_at_utc, completed_at_utc, status)"
    )


def _present(col: str) -> str:
    return f"CASE WHEN length(coalesce({col}, '')) > 0 THEN 1 ELSE 0 END"


def _scenario_sql(select: str) -> str:
    """WITH-clause of the scenario in DuckDB, followed by ``select``."""
    b, c = _many_profiles_sql()
    h = O.health(O.drift(b, c), f"SELECT table_name FROM ({b})")
    fid = " UNION ALL ".join(
        f"SELECT {O.q(t)} AS table_name, (SELECT count(*) FROM ({v[3]})) AS s, (SELECT count(*) FROM ({v[4]})) AS t"
        for t, v in LOADS.items()
    )
    qual = " UNION ALL ".join(
        f"SELECT {O.q(t)} AS table_name, count(*) FILTER (WHERE NOT coalesce({RUN_RULES_SQL[t]}, false)) / count(*) AS pass, "
        f"count(*) FILTER (WHERE coalesce({RUN_RULES_SQL[t]}, false)) / count(*) AS quar FROM ({LOADS[t][4]})"
        for t in RUN_RULES_SQL
    )
    fields = ["experiment_id", "run_id", "git_commit", "git_branch", "catalog_name", "operator", "started_at_utc"]
    cov = " + ".join(_present(f) for f in fields)
    metrics = (
        "SELECT run_id, 'entropy_health_score' AS metric, health_score AS value FROM rh UNION ALL "
        "SELECT run_id, 'entropy_columns_drifted_ratio', CASE WHEN total_columns_checked = 0 THEN NULL "
        "ELSE columns_drifted / total_columns_checked END FROM rh UNION ALL "
        "SELECT r.run_id, 'bronze_record_fidelity_ratio', f.t / nullif(f.s, 0) FROM runs r LEFT JOIN fid f USING (table_name) UNION ALL "
        "SELECT r.run_id, 'silver_quality_pass_ratio', q.pass FROM runs r LEFT JOIN qual q USING (table_name) UNION ALL "
        "SELECT r.run_id, 'silver_quarantine_ratio', q.quar FROM runs r LEFT JOIN qual q USING (table_name) UNION ALL "
        "SELECT run_id, 'provenance_field_coverage', coverage FROM led"
    )
    evals = (
        "SELECT r.run_id, g.position, g.gate_id, g.metric, g.gate_type, g.op, g.threshold, m.value AS measured_value, "
        "CASE WHEN m.value IS NULL THEN NULL WHEN g.op = '>=' THEN m.value >= g.threshold "
        "WHEN g.op = '<=' THEN m.value <= g.threshold WHEN g.op = '>' THEN m.value > g.threshold "
        "WHEN g.op = '<' THEN m.value < g.threshold WHEN g.op = '==' THEN m.value = g.threshold END AS passed "
        "FROM runs r JOIN gates g ON true LEFT JOIN metrics m ON m.run_id = r.run_id AND m.metric = g.metric"
    )
    verdict = (
        "SELECT run_id, CASE WHEN count(*) FILTER (WHERE measured_value IS NULL) > 0 THEN 'INCOMPLETE' "
        "WHEN count(*) FILTER (WHERE passed = false AND gate_type = 'FAIL') > 0 THEN 'FAIL' "
        "WHEN count(*) FILTER (WHERE passed = false AND gate_type = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END AS overall_verdict, "
        "CAST(count(*) AS BIGINT) AS gates_evaluated, "
        "coalesce(string_agg(CASE WHEN measured_value IS NULL THEN gate_id END, ',' ORDER BY position), '') AS unmeasured_gates "
        "FROM evals GROUP BY run_id"
    )
    return (
        f"WITH runs AS ({_runs_sql()}), h AS ({h}), "
        "rh AS (SELECT r.run_id, h.* FROM runs r JOIN h USING (table_name)), "
        f"fid AS ({fid}), qual AS ({qual}), "
        f"led AS (SELECT *, ({cov}) / 7 AS coverage FROM runs), "
        f"metrics AS ({metrics}), gates AS ({GATES_SQL}), evals AS ({evals}), verdicts AS ({verdict}) "
        + select
    )


# ============================================================================ gates

def q_gate_evaluations(spark, sf):
    e = Scenario(spark, sf).evaluations
    return _r6(e.select("run_id", "position", "gate_id", "metric", "gate_type", "op", "threshold", "measured_value", "passed"), "measured_value")


def sql_gate_evaluations():
    return _scenario_sql(
        "SELECT run_id, CAST(position AS INTEGER) AS position, gate_id, metric, gate_type, op, "
        "CAST(threshold AS DOUBLE) AS threshold, round(measured_value, 6) AS measured_value, passed FROM evals"
    )


def q_gate_unmeasured(spark, sf):
    e = Scenario(spark, sf).evaluations
    return e.filter(F.col("measured_value").isNull()).select("run_id", "gate_id", "details")


def sql_gate_unmeasured():
    return _scenario_sql("SELECT run_id, gate_id, 'NOT_MEASURED' AS details FROM evals WHERE measured_value IS NULL")


def q_gate_labels(spark, sf):
    return Scenario(spark, sf).evaluations.select("run_id", "gate_id", "label")


def sql_gate_labels():
    return _scenario_sql(
        "SELECT run_id, gate_id, CASE WHEN passed THEN 'PASS' WHEN NOT passed AND gate_type = 'WARN' THEN 'WARN' "
        "WHEN NOT passed THEN 'FAIL' ELSE 'N/A' END AS label FROM evals"
    )


def q_gate_verdict(spark, sf):
    v = Scenario(spark, sf).verdicts
    return v.select(
        "run_id", "overall_verdict", "gates_evaluated",
        F.array_join("unmeasured_gates", ",").alias("unmeasured_gates"),
    )


def sql_gate_verdict():
    return _scenario_sql("SELECT run_id, overall_verdict, gates_evaluated, unmeasured_gates FROM verdicts")


def q_publish_decision(spark, sf):
    return Scenario(spark, sf).verdicts.select("run_id", "overall_verdict", "gold_allowed")


def sql_publish_decision():
    return _scenario_sql(
        "SELECT run_id, overall_verdict, overall_verdict IN ('PASS', 'WARN') AS gold_allowed FROM verdicts"
    )


def q_provenance_coverage(spark, sf):
    return _r6(Scenario(spark, sf).ledger.select("run_id", "provenance_field_coverage"), "provenance_field_coverage")


def sql_provenance_coverage():
    return _scenario_sql("SELECT run_id, round(coverage, 6) AS provenance_field_coverage FROM led")


def q_run_ledger(spark, sf):
    """The runs' ledger, recorded twice: one row per run stays (SNK6)."""
    path = scratch_path(spark, "run-ledger")
    rows = materialize_small(Scenario(spark, sf).ledger)
    ledger.append_ledger(rows, path, replace_runs=True)
    ledger.append_ledger(rows, path, replace_runs=True)
    led = ledger.read_ledger(spark, path)
    return led.select(
        "experiment_id", "run_id", "git_commit", "git_branch", "catalog_name", "operator",
        "started_at_utc", "completed_at_utc", "entropy_health_score",
        F.array_join("tables_processed", ",").alias("tables_processed"), "columns_drifted", "verdict",
    )


def sql_run_ledger():
    return _scenario_sql(
        "SELECT r.experiment_id, r.run_id, r.git_commit, r.git_branch, r.catalog_name, r.operator, "
        "r.started_at_utc, r.completed_at_utc, rh.health_score AS entropy_health_score, r.table_name AS tables_processed, "
        "CAST(coalesce(rh.columns_drifted, 0) AS INTEGER) AS columns_drifted, r.status AS verdict "
        "FROM runs r LEFT JOIN rh USING (run_id)"
    )


# ============================================================================ category comparison

def q_category_comparison(spark, sf):
    return compare.category_comparison(fx.orders(spark, sf), fx.orders_drifted(spark, sf), "o_orderpriority")


def _counts_sql(base: str, cur: str, col: str) -> str:
    return (
        f"SELECT coalesce(b.v, c.v) AS value, coalesce(b.n, 0) AS bn, coalesce(c.n, 0) AS cn FROM "
        f"(SELECT CAST({col} AS VARCHAR) AS v, count(*) AS n FROM ({base}) GROUP BY 1) b FULL OUTER JOIN "
        f"(SELECT CAST({col} AS VARCHAR) AS v, count(*) AS n FROM ({cur}) GROUP BY 1) c ON b.v IS NOT DISTINCT FROM c.v"
    )


def sql_category_comparison():
    j = _counts_sql("SELECT * FROM orders", O.ORDERS_DRIFTED, "o_orderpriority")
    return (
        "SELECT CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS position, value AS category, "
        f"CAST(bn AS BIGINT) AS baseline_count, CAST(cn AS BIGINT) AS current_count FROM ({j})"
    )


def q_category_comparison_others(spark, sf):
    return compare.category_comparison(fx.table(spark, sf, "part"), fx.part_drifted(spark, sf), "p_brand")


def sql_category_comparison_others():
    j = _counts_sql("SELECT * FROM part", O.PART_DRIFTED, "p_brand")
    return (
        f"WITH j AS ({j}), "
        "tb AS (SELECT value, row_number() OVER (ORDER BY bn DESC, value) AS pick FROM j WHERE bn > 0 "
        "ORDER BY bn DESC, value LIMIT 4), "
        "tc AS (SELECT value, 4 + row_number() OVER (ORDER BY cn DESC, value) AS pick FROM j WHERE cn > 0 "
        "ORDER BY cn DESC, value LIMIT 4), "
        "picks AS (SELECT value, min(pick) AS pick FROM (SELECT * FROM tb UNION ALL SELECT * FROM tc) "
        "GROUP BY value ORDER BY pick LIMIT 5), "
        "lab AS (SELECT CASE WHEN p.pick IS NULL THEN 'Others' ELSE j.value END AS category, p.pick IS NULL AS oth, "
        "j.bn, j.cn, p.pick FROM j LEFT JOIN picks p ON j.value IS NOT DISTINCT FROM p.value), "
        "g AS (SELECT category, oth, sum(bn) AS bn, sum(cn) AS cn, min(pick) AS pick FROM lab GROUP BY category, oth) "
        "SELECT CAST(row_number() OVER (ORDER BY oth, pick NULLS LAST, category) AS INTEGER) AS position, category, "
        "CAST(bn AS BIGINT) AS baseline_count, CAST(cn AS BIGINT) AS current_count FROM g"
    )


# ============================================================================ simulation

def q_spot_checks(spark, sf):
    return simulate.spot_checks(fx.orders_drifted(spark, sf), "o_orderstatus", "F")


def sql_spot_checks():
    return (
        "SELECT CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS matching_rows, "
        "CAST(count(*) FILTER (WHERE o_orderstatus IS NULL) AS BIGINT) AS null_rows, "
        "CAST(count(DISTINCT o_orderstatus) + max(CASE WHEN o_orderstatus IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
        f"AS distinct_values, CAST(count(*) AS BIGINT) AS total_rows FROM ({O.ORDERS_DRIFTED})"
    )


def q_simulated_drift(spark, sf):
    return fx.orders_drifted(spark, sf).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def sql_simulated_drift():
    return f"SELECT o_orderkey, o_orderstatus, o_orderpriority FROM ({O.ORDERS_DRIFTED})"


# ============================================================================ release control

RELEASE_RUN = {**_CTX, "run_id": "release-orders"}


def _release(spark, sf, current: DataFrame) -> DataFrame:
    cur_rules = quality.evaluate(current, [R.not_null("o_orderpriority"), R.positive("o_totalprice")])
    rel = release_control(
        fx.orders(spark, sf), current, "orders", config_frame(spark), RELEASE_RUN,
        exclude_columns=ORDER_KEYS, quality=cur_rules.ratios,
    )
    return rel.verdict.select(
        "run_id", "table_name", "overall_verdict", "gold_allowed", "health_score", "columns_drifted",
        "total_columns_checked", F.array_join("unmeasured_gates", ",").alias("unmeasured_gates"),
    )


def q_release_control(spark, sf):
    return _release(spark, sf, fx.orders_drifted(spark, sf))


def q_release_control_healthy(spark, sf):
    return _release(spark, sf, fx.orders(spark, sf))


def _release_sql(current: str) -> str:
    b = O.profile("orders", "SELECT * FROM orders", ["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    c = O.profile("orders", current, ["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    h = O.health(O.drift(b, c), f"SELECT table_name FROM ({b})")
    rule = "o_orderpriority IS NULL OR o_totalprice IS NULL OR o_totalprice <= 0"
    return (
        f"WITH h AS ({h}), "
        f"q AS (SELECT count(*) FILTER (WHERE NOT ({rule})) / count(*) AS pass, "
        f"count(*) FILTER (WHERE {rule}) / count(*) AS quar FROM ({current})), "
        f"f AS (SELECT (SELECT count(*) FROM ({current})) / (SELECT count(*) FROM orders) AS ratio), "
        "m AS (SELECT h.health_score AS m1, f.ratio AS m2, q.pass AS m3, 1.0 AS m4, "
        "CASE WHEN h.total_columns_checked = 0 THEN NULL ELSE h.columns_drifted / h.total_columns_checked END AS m5, "
        "q.quar AS m6, h.* FROM h, f, q) "
        "SELECT 'release-orders' AS run_id, table_name, "
        "CASE WHEN m1 IS NULL OR m2 IS NULL OR m3 IS NULL OR m5 IS NULL OR m6 IS NULL THEN 'INCOMPLETE' "
        "WHEN NOT (m1 >= 0.7 AND m2 >= 0.99 AND m3 >= 0.95 AND m4 >= 1.0) THEN 'FAIL' "
        "WHEN NOT (m5 <= 0.2 AND m6 <= 0.1) THEN 'WARN' ELSE 'PASS' END AS overall_verdict, "
        "(m1 >= 0.7 AND m2 >= 0.99 AND m3 >= 0.95 AND m4 >= 1.0) AS gold_allowed, "
        "health_score, columns_drifted, total_columns_checked, '' AS unmeasured_gates FROM m"
    )


def sql_release_control():
    return _release_sql(O.ORDERS_DRIFTED)


def sql_release_control_healthy():
    return _release_sql("SELECT * FROM orders")


# ============================================================================ streaming audit

def q_stream_audit_log(spark, sf):
    """The events table as a file stream: each micro-batch (one file here) is one load cycle."""
    from driftgate.streaming.audit import audit_stream, read_stream_audit

    schema = fx.table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf}/events[.]parquet")
    target = scratch_path(spark, "stream-audit")
    audit_stream(stream, "events", target, scratch_path(spark, "stream-audit-checkpoint"), exclude_columns=[]).awaitTermination()
    return read_stream_audit(spark, target).drop("measurement_ts")


def sql_stream_audit_log():
    p = O.profile("events", "SELECT * FROM events", O.EVENTS_COLS)
    return f"SELECT *, CAST(0 AS BIGINT) AS batch_id FROM ({p})"
