"""The query catalogue: every operator of the inventory as a (Spark query, DuckDB oracle) pair.

Each Spark query takes (spark, sf_dir), reads the given tables (or frames Spark derives
from them) in full and returns a DataFrame. Doubles that the reference leaves unrounded
(drift magnitude, stability, ratios) are rounded to 6 places on both sides so that value
hashes are stable.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.functions import rules as R
from driftgate.operators import bronze, drift, fidelity, quality
from driftgate.operators.identity import identified
from driftgate.operators.profile import PROFILE_COLUMNS, column_entropy, profile, profile_tables, value_frequencies
from driftgate.plans import fixtures as fx
from driftgate.plans import oracle as O
from driftgate.session import scratch_path
from driftgate.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]

CONFIG_PATH = os.path.join(os.path.dirname(__file__), "..", "..", "config", "kpi_thresholds.json")
T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
_HEALTH_COLS = ["table_name", "health_score", "passed_gate", "total_columns_checked", "columns_drifted"]
ORDER_KEYS = ["o_orderkey", "o_custkey"]
ORDERS_MONITORED = ["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def config_frame(spark: SparkSession) -> DataFrame:
    """Our gate configuration, read on the driver (a small config file) into a frame."""
    with open(CONFIG_PATH) as fh:
        text = fh.read()
    return readers.config_from_text(spark, text)


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


# ============================================================================ profiles

def q_value_frequencies(spark, sf):
    return value_frequencies(fx.orders_nulls(spark, sf), columns=["o_orderpriority"], table_name="orders_nulls")


def sql_value_frequencies():
    return (
        "SELECT 'orders_nulls' AS table_name, 'o_orderpriority' AS column_name, o_orderpriority AS value, "
        f"count(*) AS frequency FROM ({O.ORDERS_NULLS}) GROUP BY o_orderpriority"
    )


def q_entropy_column(spark, sf):
    return column_entropy(fx.table(spark, sf, "lineitem"), "l_returnflag")


def sql_entropy_column():
    return f"SELECT column_name, entropy, total_count FROM ({O.profile('lineitem', 'SELECT * FROM lineitem', ['l_returnflag'])})"


def q_normalized_entropy(spark, sf):
    return profile(fx.table(spark, sf, "events"), "events", columns=["event_type"]).select(
        "column_name", "entropy", "normalized_entropy", "distinct_count"
    )


def sql_normalized_entropy():
    p = O.profile("events", "SELECT * FROM events", ["event_type"])
    return f"SELECT column_name, entropy, normalized_entropy, distinct_count FROM ({p})"


def _whole_profile(name: str, cols: list[str]):
    def q_(spark, sf):
        return profile(fx.table(spark, sf, name), name, exclude_columns=[])

    def sql_():
        return O.profile(name, f"SELECT * FROM {name}", cols)

    return q_, sql_


q_entropy_profile_orders, sql_entropy_profile_orders = _whole_profile("orders", O.ORDERS_COLS)
q_entropy_profile_lineitem, sql_entropy_profile_lineitem = _whole_profile("lineitem", O.LINEITEM_COLS)
q_entropy_profile_customer, sql_entropy_profile_customer = _whole_profile("customer", O.CUSTOMER_COLS)
q_entropy_profile_documents, sql_entropy_profile_documents = _whole_profile("documents", O.DOCUMENTS_COLS)


def q_entropy_profile_many(spark, sf):
    frames = {n: fx.table(spark, sf, n) for n in ("orders", "customer", "part", "nation")}
    return profile_tables(frames, exclude_columns=[])


def sql_entropy_profile_many():
    return O.profiles(
        [
            ("orders", "SELECT * FROM orders", O.ORDERS_COLS),
            ("customer", "SELECT * FROM customer", O.CUSTOMER_COLS),
            ("part", "SELECT * FROM part", O.PART_COLS),
            ("nation", "SELECT * FROM nation", O.NATION_COLS),
        ]
    )


def q_entropy_profile_nulls(spark, sf):
    return profile(fx.orders_nulls(spark, sf), "orders_nulls", exclude_columns=[])


def sql_entropy_profile_nulls():
    return O.profile("orders_nulls", O.ORDERS_NULLS, O.ORDERS_COLS)


def q_entropy_profile_excluded(spark, sf):
    bronze_orders = fx.with_lineage(fx.orders(spark, sf), "tpch", "tpch.orders", T1)
    return profile(bronze_orders, "orders_bronze")  # lineage columns excluded by default


def sql_entropy_profile_excluded():
    return O.profile("orders_bronze", "SELECT * FROM orders", O.ORDERS_COLS)


def q_entropy_profile_empty(spark, sf):
    return profile(fx.table(spark, sf, "part").filter(F.lit(False)), "part_empty", exclude_columns=[])


def sql_entropy_profile_empty():
    return O.profile("part_empty", "SELECT * FROM part WHERE false", O.PART_COLS)


def q_csv_profile(spark, sf):
    path = scratch_path(spark, "orders-csv")
    fx.orders(spark, sf).write.option("header", True).csv(path)
    return profile(readers.read_csv_strings(spark, path), "orders_csv", exclude_columns=[])


def sql_csv_profile():
    return O.profile("orders_csv", "SELECT * FROM orders", O.ORDERS_COLS)


# ============================================================================ baselines

def _history_view(df: DataFrame) -> DataFrame:
    extra = ["baseline_version"] if "baseline_version" in df.columns else []
    return df.select(*PROFILE_COLUMNS, F.col("measurement_ts").cast("string").alias("measurement_ts"), *extra)


def _history_sql(profile_sql: str, ts: str, version: bool) -> str:
    v = ", CAST(1 AS INTEGER) AS baseline_version" if version else ""
    return f"SELECT *, {O.q(ts)} AS measurement_ts{v} FROM ({profile_sql})"


def q_baseline_capture(spark, sf):
    path = scratch_path(spark, "baselines")
    stored = sinks.capture_baseline({"orders": fx.orders(spark, sf)}, path, exclude_columns=ORDER_KEYS, measurement_ts=T1)
    return _history_view(stored)


def sql_baseline_capture():
    return _history_sql(O.profile("orders", "SELECT * FROM orders", ORDERS_MONITORED), T1, True)


def q_audit_log(spark, sf):
    path = scratch_path(spark, "audit")
    sinks.log_measurement({"orders": fx.orders(spark, sf)}, path, exclude_columns=ORDER_KEYS, measurement_ts=T1)
    sinks.log_measurement({"orders": fx.orders_drifted(spark, sf)}, path, exclude_columns=ORDER_KEYS, measurement_ts=T2)
    return _history_view(sinks.read_audit_log(spark, path))


def sql_audit_log():
    a = _history_sql(O.profile("orders", "SELECT * FROM orders", ORDERS_MONITORED), T1, False)
    b = _history_sql(O.profile("orders", O.ORDERS_DRIFTED, ORDERS_MONITORED), T2, False)
    return f"({a}) UNION ALL ({b})"


def _schema(spark, name: str) -> str:
    """A fresh database below the shared folder."""
    base = scratch_path(spark, name)
    schema = os.path.basename(base).replace("-", "_")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{base}'")
    return schema


def q_latest_baseline(spark, sf):
    table = _schema(spark, "baselines") + ".baselines"
    sinks.capture_baseline(
        {"orders": fx.orders(spark, sf), "customer": fx.table(spark, sf, "customer")},
        table, exclude_columns=ORDER_KEYS + ["c_custkey"], measurement_ts=T1,
    )
    for _ in range(2):  # a retried capture is stored once
        sinks.capture_baseline({"orders": fx.orders_drifted(spark, sf)}, table, exclude_columns=ORDER_KEYS, measurement_ts=T2)
    return _history_view(sinks.latest(spark, table))


def sql_latest_baseline():
    a = _history_sql(O.profile("orders", O.ORDERS_DRIFTED, ORDERS_MONITORED), T2, True)
    b = _history_sql(O.profile("customer", "SELECT * FROM customer", O.CUSTOMER_COLS[1:]), T1, True)
    return f"({a}) UNION ALL ({b})"


T3 = "2024-03-01 00:00:00"


def q_health_history(spark, sf):
    path = scratch_path(spark, "audit-trend")
    base = profile(fx.orders(spark, sf), "orders", exclude_columns=ORDER_KEYS)
    for ts, load in ((T1, fx.orders), (T2, fx.orders_drifted), (T3, fx.orders_nulls)):
        sinks.log_measurement({"orders": load(spark, sf)}, path, exclude_columns=ORDER_KEYS, measurement_ts=ts)
    h = drift.health_history(base, sinks.read_audit_log(spark, path))
    return h.select(
        "table_name", F.col("measurement_ts").cast("string").alias("measurement_ts"), *_HEALTH_COLS[1:]
    )


def sql_health_history():
    b = O.profile("orders", "SELECT * FROM orders", ORDERS_MONITORED)
    parts = []
    for ts, src in ((T1, "SELECT * FROM orders"), (T2, O.ORDERS_DRIFTED), (T3, O.ORDERS_NULLS)):
        c = O.profile("orders", src, ORDERS_MONITORED)
        h = O.health(O.drift(b, c), f"SELECT table_name FROM ({c})")
        parts.append(f"SELECT table_name, {O.q(ts)} AS measurement_ts, {', '.join(_HEALTH_COLS[1:])} FROM ({h})")
    return " UNION ALL ".join(parts)


# ============================================================================ drift and health

def _orders_profiles(spark, sf):
    b = profile(fx.orders(spark, sf), "orders", exclude_columns=ORDER_KEYS)
    c = profile(fx.orders_drifted(spark, sf), "orders", exclude_columns=ORDER_KEYS)
    return b, c


def _orders_profiles_sql():
    b = O.profile("orders", "SELECT * FROM orders", ORDERS_MONITORED)
    c = O.profile("orders", O.ORDERS_DRIFTED, ORDERS_MONITORED)
    return b, c


def _drift_out(df: DataFrame) -> DataFrame:
    return _r6(df, "drift_magnitude", "stability_score")


def _drift_out_sql(sql: str) -> str:
    return (
        "SELECT * REPLACE (round(drift_magnitude, 6) AS drift_magnitude, "
        f"round(stability_score, 6) AS stability_score) FROM ({sql})"
    )


def q_column_drift(spark, sf):
    return _drift_out(drift.column_drift(*_orders_profiles(spark, sf)))


def sql_column_drift():
    return _drift_out_sql(O.drift(*_orders_profiles_sql()))


def q_column_drift_thresholds(spark, sf):
    return _drift_out(drift.column_drift(*_orders_profiles(spark, sf), drop_pct=0.9, spike_pct=0.9))


def sql_column_drift_thresholds():
    return _drift_out_sql(O.drift(*_orders_profiles_sql(), drop=0.9, spike=0.9))


def q_drift_unmatched_columns(spark, sf):
    b = profile(fx.orders(spark, sf), "orders", exclude_columns=ORDER_KEYS)
    cur = fx.orders_drifted(spark, sf).withColumn("o_year", F.year("o_orderdate")).drop("o_orderdate")
    c = profile(cur, "orders", exclude_columns=ORDER_KEYS)
    return drift.unmatched_columns(b, c)


def sql_drift_unmatched_columns():
    return (
        "SELECT 'orders' AS table_name, 'o_orderdate' AS column_name, 'baseline_only' AS side "
        "FROM (SELECT count(*) FROM orders) UNION ALL "
        "SELECT 'orders', 'o_year', 'current_only' FROM (SELECT count(*) FROM orders)"
    )




def q_table_health(spark, sf):
    return drift.table_health(*_orders_profiles(spark, sf)).select(_HEALTH_COLS)


def sql_table_health():
    b, c = _orders_profiles_sql()
    h = O.health(O.drift(b, c), f"SELECT table_name FROM ({b}) UNION ALL SELECT table_name FROM ({c})")
    return f"SELECT {', '.join(_HEALTH_COLS)} FROM ({h})"


WEIGHTS = {"o_orderstatus": 3.0, "o_orderpriority": 2.0}


def q_table_health_weighted(spark, sf):
    return drift.table_health(*_orders_profiles(spark, sf), weights=WEIGHTS).select(_HEALTH_COLS)


def sql_table_health_weighted():
    b, c = _orders_profiles_sql()
    h = O.health(O.drift(b, c), f"SELECT table_name FROM ({b})", weights=WEIGHTS)
    return f"SELECT {', '.join(_HEALTH_COLS)} FROM ({h})"


def _no_common(spark, sf):
    b, c = _orders_profiles(spark, sf)
    pb = profile(fx.table(spark, sf, "part"), "part", exclude_columns=[])
    pc = profile(fx.table(spark, sf, "nation"), "part", exclude_columns=[])
    return b.unionByName(pb), c.unionByName(pc)


def _no_common_sql():
    b, c = _orders_profiles_sql()
    pb = O.profile("part", "SELECT * FROM part", O.PART_COLS)
    pc = O.profile("part", "SELECT * FROM nation", O.NATION_COLS)
    return f"({b}) UNION ALL ({pb})", f"({c}) UNION ALL ({pc})"


def q_table_health_no_common(spark, sf):
    return drift.table_health(*_no_common(spark, sf)).select(_HEALTH_COLS)


def sql_table_health_no_common():
    b, c = _no_common_sql()
    h = O.health(O.drift(b, c), f"SELECT table_name FROM ({b}) UNION ALL SELECT table_name FROM ({c})")
    return f"SELECT {', '.join(_HEALTH_COLS)} FROM ({h})"


# Four loads with monitored columns, used by the multi-table and multi-run queries.
LOADS = {
    "orders": (fx.orders, fx.orders_drifted, ORDERS_MONITORED, "SELECT * FROM orders", O.ORDERS_DRIFTED),
    "customer": (
        lambda s, d: fx.table(s, d, "customer"), fx.customer_dirty,
        ["c_nationkey", "c_acctbal", "c_mktsegment"], "SELECT * FROM customer", O.CUSTOMER_DIRTY,
    ),
    "part": (
        lambda s, d: fx.table(s, d, "part"), fx.part_drifted,
        ["p_brand", "p_type", "p_size", "p_retailprice"], "SELECT * FROM part", O.PART_DRIFTED,
    ),
    "events": (fx.events_base, fx.events_current, ["user_id", "event_type", "value"], O.EVENTS_BASE, O.EVENTS_CURRENT),
}


def _many_profiles(spark, sf):
    base = profile_tables({t: v[0](spark, sf) for t, v in LOADS.items()}, columns={t: v[2] for t, v in LOADS.items()})
    cur = profile_tables({t: v[1](spark, sf) for t, v in LOADS.items()}, columns={t: v[2] for t, v in LOADS.items()})
    return base, cur


def _many_profiles_sql():
    b = O.profiles([(t, v[3], v[2]) for t, v in LOADS.items()])
    c = O.profiles([(t, v[4], v[2]) for t, v in LOADS.items()])
    return b, c


def q_table_health_many(spark, sf):
    return drift.table_health(*_many_profiles(spark, sf)).select(_HEALTH_COLS)


def sql_table_health_many():
    b, c = _many_profiles_sql()
    h = O.health(O.drift(b, c), f"SELECT table_name FROM ({b})")
    return f"SELECT {', '.join(_HEALTH_COLS)} FROM ({h})"


def q_flagged_columns(spark, sf):
    h = drift.table_health(*_many_profiles(spark, sf))
    return h.select(
        "table_name",
        F.array_join(F.transform("flagged_columns", lambda d: d["column_name"]), ",").alias("flagged"),
        F.array_join(
            F.transform("column_details", lambda d: F.concat(d["column_name"], F.lit(":"), d["drift_direction"])), ","
        ).alias("directions"),
    )


def sql_flagged_columns():
    b, c = _many_profiles_sql()
    h = O.health(O.drift(b, c), f"SELECT table_name FROM ({b})")
    return f"SELECT table_name, flagged, directions FROM ({h})"


def q_drifted_ratio(spark, sf):
    b, c = _many_profiles(spark, sf)
    pb = profile(fx.table(spark, sf, "part"), "part_renamed", exclude_columns=[])
    pc = profile(fx.table(spark, sf, "nation"), "part_renamed", exclude_columns=[])
    h = drift.table_health(b.unionByName(pb), c.unionByName(pc))
    return _r6(drift.drifted_ratio(h), "drifted_ratio")


def sql_drifted_ratio():
    b, c = _many_profiles_sql()
    b = f"({b}) UNION ALL ({O.profile('part_renamed', 'SELECT * FROM part', O.PART_COLS)})"
    c = f"({c}) UNION ALL ({O.profile('part_renamed', 'SELECT * FROM nation', O.NATION_COLS)})"
    h = O.health(O.drift(b, c), f"SELECT table_name FROM ({b})")
    return (
        "SELECT table_name, round(CASE WHEN total_columns_checked = 0 THEN NULL "
        f"ELSE columns_drifted / total_columns_checked END, 6) AS drifted_ratio FROM ({h})"
    )


# ============================================================================ quality rules

def _quarantine_of(df: DataFrame, rules, cols=None) -> DataFrame:
    out = quality.evaluate(df, rules).quarantine
    return out.select(*(cols or df.columns), "failure_reason")


def q_rule_not_null(spark, sf):
    return _quarantine_of(fx.customer_dirty(spark, sf), [R.not_null("c_nationkey")])


def sql_rule_not_null():
    return f"SELECT *, 'c_nationkey_not_null' AS failure_reason FROM ({O.CUSTOMER_DIRTY}) WHERE c_nationkey IS NULL"


def q_rule_positive(spark, sf):
    return _quarantine_of(fx.customer_dirty(spark, sf), [R.positive("c_acctbal")])


def sql_rule_positive():
    return (
        f"SELECT *, 'c_acctbal_positive' AS failure_reason FROM ({O.CUSTOMER_DIRTY}) "
        "WHERE c_acctbal IS NULL OR c_acctbal <= 0"
    )


EVENT_OUT = ["event_id", "user_id", "event_type", "value"]


def q_rule_date_range(spark, sf):
    rule = R.valid_date_range("ts", as_of="2024-01-20")
    return _quarantine_of(fx.table(spark, sf, "events"), [rule], EVENT_OUT)


def sql_rule_date_range():
    return (
        "SELECT event_id, user_id, event_type, value, 'ts_date_range' AS failure_reason FROM events "
        "WHERE ts IS NULL OR ts > TIMESTAMP '2024-01-20 00:00:00' OR ts < TIMESTAMP '2009-01-01 00:00:00'"
    )


DOC_OUT = ["doc_id", "lang", "source", "n_chars"]


def q_rule_no_duplicates(spark, sf):
    docs = identified(fx.table(spark, sf, "documents"))
    return _quarantine_of(docs, [R.no_duplicates("text", "doc_id")], DOC_OUT)


def sql_rule_no_duplicates():
    return (
        "SELECT doc_id, lang, source, n_chars, 'text_unique' AS failure_reason FROM "
        "(SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn > 1"
    )


def q_rule_custom(spark, sf):
    rule = R.custom("value_outlier", "value", lambda c: F.col(c) >= 400)
    return _quarantine_of(fx.table(spark, sf, "events"), [rule], EVENT_OUT)


def sql_rule_custom():
    return "SELECT event_id, user_id, event_type, value, 'value_outlier' AS failure_reason FROM events WHERE value >= 400"


CUSTOMER_RULES = [
    R.not_null("c_nationkey"),
    R.positive("c_acctbal"),
    R.no_duplicates("c_name", "c_custkey"),
]


def _customer_outcome(spark, sf):
    return quality.evaluate(fx.customer_dirty(spark, sf), CUSTOMER_RULES)


def _customer_routed(spark, sf):
    """Both sides and the counts of one pass over the identified rows."""
    out = quality.evaluate(identified(fx.customer_dirty(spark, sf)), CUSTOMER_RULES)
    return quality.route(out, scratch_path(spark, "routed"))


def _customer_tagged_sql():
    t = O.first_failure(
        O.CUSTOMER_DIRTY,
        [("c_nationkey_not_null", "c_nationkey IS NULL"), ("c_acctbal_positive", "c_acctbal IS NULL OR c_acctbal <= 0")],
    )
    return O.then_duplicates(t, "c_name_unique", ["c_name"], ["c_custkey"])


def q_quality_clean(spark, sf):
    return _customer_routed(spark, sf).clean


def sql_quality_clean():
    return f"SELECT * EXCLUDE (failure_reason) FROM ({_customer_tagged_sql()}) WHERE failure_reason IS NULL"


def q_quality_quarantine(spark, sf):
    return _customer_routed(spark, sf).quarantine


def sql_quality_quarantine():
    return f"SELECT * FROM ({_customer_tagged_sql()}) WHERE failure_reason IS NOT NULL"


def _results_sql(tagged: str, rules: list[tuple[int, str, str, str]]) -> str:
    spine = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS rule_position, {O.q(n)} AS rule_name, {O.q(c)} AS column_name, {O.q(a)} AS action"
        for i, n, c, a in rules
    )
    return (
        "SELECT s.rule_position, s.rule_name, s.column_name, coalesce(f.n, 0) = 0 AS passed, "
        "CAST(t.total AS BIGINT) AS records_checked, CAST(coalesce(f.n, 0) AS BIGINT) AS records_failed, "
        f"CASE WHEN t.total > 0 THEN {O.rnd('coalesce(f.n, 0) / t.total', 4)} ELSE 0.0::DOUBLE END AS failure_ratio, "
        "CASE WHEN coalesce(f.n, 0) > 0 THEN s.action ELSE 'NONE' END AS action_taken "
        f"FROM ({spine}) s LEFT JOIN (SELECT failure_reason, count(*) AS n FROM ({tagged}) GROUP BY 1) f "
        f"ON s.rule_name = f.failure_reason, (SELECT count(*) AS total FROM ({tagged})) t"
    )


def q_quality_results(spark, sf):
    return _customer_routed(spark, sf).results


def sql_quality_results():
    rules = [(i, r.name, r.column, r.action) for i, r in enumerate(CUSTOMER_RULES, start=1)]
    return _results_sql(_customer_tagged_sql(), rules)


def q_quality_ratios(spark, sf):
    return _r6(_customer_routed(spark, sf).ratios, "quality_pass_ratio", "quarantine_ratio")


def sql_quality_ratios():
    t = _customer_tagged_sql()
    return (
        "SELECT CAST(count(*) AS BIGINT) AS records_checked, "
        "CAST(count(*) FILTER (WHERE failure_reason IS NULL) AS BIGINT) AS records_clean, "
        "CAST(count(*) FILTER (WHERE failure_reason IS NOT NULL) AS BIGINT) AS records_quarantined, "
        "round(count(*) FILTER (WHERE failure_reason IS NULL) / count(*), 6) AS quality_pass_ratio, "
        f"round(count(*) FILTER (WHERE failure_reason IS NOT NULL) / count(*), 6) AS quarantine_ratio FROM ({t})"
    )


DOC_RULES = [
    R.custom("short_text", "n_chars", lambda c: F.col(c) < 200),
    R.no_duplicates("text", "doc_id"),
    R.custom("english_only", "lang", lambda c: F.col(c) != "en"),
]


def q_quality_duplicates_midway(spark, sf):
    return quality.evaluate(identified(fx.table(spark, sf, "documents")), DOC_RULES).results


def sql_quality_duplicates_midway():
    t = O.first_failure("SELECT * FROM documents", [("short_text", "n_chars < 200")])
    t = O.then_duplicates(t, "text_unique", ["text"], ["doc_id"])
    t = f"SELECT * REPLACE (coalesce(failure_reason, CASE WHEN lang <> 'en' THEN 'english_only' END) AS failure_reason) FROM ({t})"
    rules = [(i, r.name, r.column, r.action) for i, r in enumerate(DOC_RULES, start=1)]
    return _results_sql(t, rules)


def q_quality_clean_set_semantics(spark, sf):
    return _customer_outcome(spark, sf).clean_set_semantics


def sql_quality_clean_set_semantics():
    t = _customer_tagged_sql()
    return (
        f"SELECT * FROM ({O.CUSTOMER_DIRTY}) EXCEPT "
        f"SELECT * EXCLUDE (failure_reason) FROM ({t}) WHERE failure_reason IS NOT NULL"
    )


def q_quarantine_union(spark, sf):
    cq = _customer_outcome(spark, sf).quarantine
    oq = quality.evaluate(fx.orders_nulls(spark, sf), [R.not_null("o_orderpriority")]).quarantine
    oq = oq.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    return quality.union_quarantine([cq, oq])


def sql_quarantine_union():
    c = _customer_tagged_sql()
    return (
        "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, "
        "NULL::BIGINT AS o_orderkey, NULL::BIGINT AS o_custkey, NULL::VARCHAR AS o_orderstatus, "
        "NULL::DOUBLE AS o_totalprice, NULL::VARCHAR AS o_orderdate, NULL::VARCHAR AS o_orderpriority, failure_reason "
        f"FROM ({c}) WHERE failure_reason IS NOT NULL UNION ALL "
        "SELECT NULL::BIGINT, NULL::VARCHAR, NULL::INTEGER, NULL::DOUBLE, NULL::VARCHAR, "
        "o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR), o_orderpriority, "
        f"'o_orderpriority_not_null' FROM ({O.ORDERS_NULLS}) WHERE o_orderpriority IS NULL"
    )


# ============================================================================ bronze and fidelity

def _bronze(spark, sf, name):
    view = f"bronze_src_{name}"
    fx.table(spark, sf, name).createOrReplaceTempView(view)
    base = scratch_path(spark, "bronze")
    schema = "bronze_" + os.path.basename(base).replace("-", "_")
    target = f"{schema}.{name}"
    args = dict(
        source_system="tpch", source_label=f"tpch.{name}", ingest_ts=T1,
        location=os.path.join(base, name), schema_location=os.path.join(base, "schema"),
    )
    return view, target, args


def q_bronze_materialize(spark, sf):
    view, target, args = _bronze(spark, sf, "customer")
    bronze.materialize(spark, view, target, **args)
    return spark.table(target).drop("ingest_ts")


def sql_bronze_materialize():
    return "SELECT *, 'tpch' AS source_system, 'tpch.customer' AS source_file_path FROM customer"


def q_bronze_report(spark, sf):
    """Orders landed: dry run, landing and a second call, next to what the landed table holds."""
    view, target, args = _bronze(spark, sf, "orders")
    dry = bronze.materialize(spark, view, target, dry_run=True, **args).withColumn("call", F.lit(1))
    first = bronze.materialize(spark, view, target, **args).withColumn("call", F.lit(2))
    again = bronze.materialize(spark, view, target, **args).withColumn("call", F.lit(3))
    held = spark.table(target).groupBy("source_file_path").agg(
        F.count(F.lit(1)).alias("target_rows"), F.countDistinct("o_custkey").alias("customers"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    report = dry.unionByName(first).unionByName(again).drop("target").withColumn("landed_from", F.when(F.col("call") > 1, F.lit("tpch.orders")))
    return report.join(held, report["landed_from"] == held["source_file_path"], "left").drop("landed_from")


def sql_bronze_report():
    return (
        "WITH v AS (SELECT * FROM (VALUES (false, false, false, 2, 0, 1), (true, false, true, 2, 2, 2), "
        "(true, true, true, 2, 2, 3)) AS t(executed, target_exists_before, target_exists_after, "
        "statements_attempted, statements_executed, call_no)), "
        "held AS (SELECT 'tpch.orders' AS source_file_path, CAST(count(*) AS BIGINT) AS target_rows, "
        "CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers, round(sum(o_totalprice), 2) AS total FROM orders) "
        "SELECT executed, target_exists_before, target_exists_after, "
        "CAST(statements_attempted AS INTEGER) AS statements_attempted, "
        "CAST(statements_executed AS INTEGER) AS statements_executed, CAST(call_no AS INTEGER) AS call, "
        "CASE WHEN call_no = 2 THEN target_rows END AS rows_landed, source_file_path, target_rows, customers, total "
        "FROM v LEFT JOIN held ON call_no > 1"
    )


def _fidelity_target(spark, sf):
    o = fx.orders(spark, sf)
    return (
        o.filter(F.col("o_orderstatus") != "P")
        .withColumnRenamed("o_orderpriority", "o_priority")
        .withColumn("_change_type", F.lit("insert"))
    )


def q_fidelity(spark, sf):
    f = fidelity.fidelity(fx.orders(spark, sf), _fidelity_target(spark, sf))
    return _r6(f, "row_count_ratio").withColumn("mismatched_columns", F.array_join("mismatched_columns", ","))


def sql_fidelity():
    return (
        "SELECT s.n AS source_row_count, t.n AS target_row_count, round(t.n / nullif(s.n, 0), 6) AS row_count_ratio, "
        "false AS columns_match, 'missing_in_target:o_orderpriority,extra_in_target:o_priority' AS mismatched_columns "
        "FROM (SELECT count(*) AS n FROM orders) s, (SELECT count(*) AS n FROM orders WHERE o_orderstatus <> 'P') t"
    )
