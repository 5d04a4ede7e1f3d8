"""DuckDB SQL that states, independently of the Spark code, what each catalogue query returns.

Entropy here uses the direct form -sum(p*log2 p) with p = f / sum(f) OVER (), not the
algebraic form the Spark operator uses, so the two sides check each other.
"""

from __future__ import annotations

from collections.abc import Sequence

# ----------------------------------------------------------------------------- fixtures

ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
NATION_COLS = ["n_nationkey", "n_name", "n_regionkey"]
EVENTS_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
DOCUMENTS_COLS = ["doc_id", "text", "lang", "source", "n_chars"]

ORDERS_DRIFTED = (
    "SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice, o_orderdate, "
    "CASE WHEN o_orderkey % 20 <> 0 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority FROM orders"
)
ORDERS_NULLS = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders"
)
CUSTOMER_DIRTY = (
    "SELECT c_custkey, c_name, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey, "
    "c_acctbal, c_mktsegment FROM customer"
)
PART_DRIFTED = (
    "SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 <> 0 THEN 'Brand#11' ELSE p_brand END AS p_brand, "
    "p_type, p_size, p_retailprice FROM part"
)
EVENTS_BASE = "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'"
EVENTS_CURRENT = "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'"


def rnd(x: str, digits: int) -> str:
    """Python-style rounding of a DOUBLE (same arithmetic as functions.entropy.round_exact)."""
    sc = f"{float(10 ** digits)!r}::DOUBLE"
    a = f"abs(({x})::DOUBLE)"
    p = f"({a} * {sc})"
    c = f"({a} * 134217729.0::DOUBLE)"
    hi = f"({c} - ({c} - {a}))"
    lo = f"({a} - {hi})"
    e = f"(({hi} * {sc} - {p}) + {lo} * {sc})"
    k = f"floor({p})"
    t = f"(({p} - {k}) - 0.5::DOUBLE)"
    odd = f"({k} - 2.0::DOUBLE * floor({k} / 2.0::DOUBLE) = 1.0::DOUBLE)"
    up = f"(CASE WHEN {t} > 0 THEN true WHEN {t} < 0 THEN false WHEN {e} > 0 THEN true WHEN {e} < 0 THEN false ELSE {odd} END)"
    r = f"((CASE WHEN {up} THEN {k} + 1.0::DOUBLE ELSE {k} END) / {sc})"
    return f"(CASE WHEN ({x}) < 0 THEN -{r} ELSE {r} END)"


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# ----------------------------------------------------------------------------- profile

CLASS_SQL = (
    "CASE WHEN distinct_count <= 1 OR entropy = 0 THEN 'CONSTANT' "
    "WHEN normalized_entropy < 0.15 THEN 'VERY_LOW' WHEN normalized_entropy < 0.4 THEN 'LOW' "
    "WHEN normalized_entropy < 0.7 THEN 'MODERATE' WHEN normalized_entropy < 0.9 THEN 'HIGH' "
    "ELSE 'VERY_HIGH' END"
)


def profile(table: str, source: str, columns: Sequence[str]) -> str:
    """Profile rows (PROFILE_SCHEMA) of ``columns`` of the relation ``source``."""
    parts = []
    for c in columns:
        parts.append(
            f"SELECT {q(table)} AS table_name, {q(c)} AS column_name, "
            f"CASE WHEN count(*) <= 1 THEN 0.0::DOUBLE ELSE {rnd('0.0 - sum(p * log2(p))', 6)} END AS entropy, "
            "CAST(count(*) AS BIGINT) AS distinct_count, "
            "CAST(coalesce(sum(CASE WHEN v IS NULL THEN f END), 0) AS BIGINT) AS null_count, "
            "CAST(coalesce(sum(f), 0) AS BIGINT) AS total_count "
            f"FROM (SELECT v, f, f / sum(f) OVER () AS p FROM "
            f"(SELECT \"{c}\" AS v, count(*) AS f FROM ({source}) GROUP BY 1))"
        )
    inner = " UNION ALL ".join(parts)
    mid = (
        "SELECT table_name, column_name, entropy, "
        f"CASE WHEN distinct_count <= 1 THEN 0.0::DOUBLE ELSE {rnd('entropy / log2(distinct_count)', 6)} END "
        "AS normalized_entropy, distinct_count, null_count, "
        f"CASE WHEN total_count > 0 THEN {rnd('null_count / total_count', 4)} ELSE 0.0::DOUBLE END AS null_ratio, "
        f"total_count FROM ({inner})"
    )
    return f"SELECT *, {CLASS_SQL} AS entropy_class FROM ({mid})"


def profiles(items: Sequence[tuple[str, str, Sequence[str]]]) -> str:
    return " UNION ALL ".join(f"({profile(t, s, cs)})" for t, s, cs in items)


# ----------------------------------------------------------------------------- drift

def drift(baseline: str, current: str, drop: float = 0.5, spike: float = 0.5) -> str:
    """Drift rows with unrounded magnitude / stability (round in the caller)."""
    return (
        "SELECT table_name, column_name, baseline_entropy, current_entropy, "
        "drift_direction <> 'STABLE' AS drift_detected, drift_direction, drift_magnitude, stability_score FROM ("
        "SELECT *, "
        "CASE WHEN b = 0 AND c = 0 THEN 'STABLE' WHEN b = 0 THEN 'SPIKE' "
        f"WHEN pc < -{drop} THEN 'COLLAPSE' WHEN pc > {spike} THEN 'SPIKE' ELSE 'STABLE' END AS drift_direction, "
        "CASE WHEN b = 0 AND c = 0 THEN 0.0::DOUBLE WHEN b = 0 THEN 1.0::DOUBLE ELSE abs(pc) END AS drift_magnitude, "
        "CASE WHEN b = 0 AND c = 0 THEN 1.0::DOUBLE WHEN b = 0 THEN 0.0::DOUBLE "
        "ELSE greatest(0.0::DOUBLE, 1.0 - abs(pc)) END AS stability_score FROM ("
        "SELECT bb.table_name, bb.column_name, bb.entropy AS baseline_entropy, cc.entropy AS current_entropy, "
        "bb.entropy AS b, cc.entropy AS c, (cc.entropy - bb.entropy) / nullif(bb.entropy, 0) AS pc "
        f"FROM ({baseline}) bb JOIN ({current}) cc ON bb.table_name = cc.table_name "
        "AND bb.column_name = cc.column_name))"
    )


def health(drift_sql: str, tables_sql: str, weights: dict[str, float] | None = None, floor: float = 0.7) -> str:
    """(table_name, health_score, passed_gate, total_columns_checked, columns_drifted, flagged)."""
    if weights:
        cases = " ".join(f"WHEN {q(c)} THEN {float(w)}" for c, w in weights.items())
        w = f"CASE column_name {cases} ELSE 1.0 END"
    else:
        w = "1.0"
    agg = (
        f"SELECT table_name, sum(stability_score * {w}) AS ws, sum({w}) AS w, count(*) AS n, "
        "count(*) FILTER (WHERE drift_detected) AS nd, "
        "string_agg(CASE WHEN drift_detected THEN column_name END, ',' ORDER BY column_name) AS flagged, "
        "string_agg(column_name || ':' || drift_direction, ',' ORDER BY column_name) AS directions "
        f"FROM ({drift_sql}) GROUP BY table_name"
    )
    return (
        "SELECT t.table_name, "
        f"CASE WHEN coalesce(a.w, 0) > 0 THEN {rnd('a.ws / a.w', 4)} ELSE 0.0::DOUBLE END AS health_score, "
        f"(CASE WHEN coalesce(a.w, 0) > 0 THEN {rnd('a.ws / a.w', 4)} ELSE 0.0::DOUBLE END) >= {floor} AS passed_gate, "
        "CAST(coalesce(a.n, 0) AS INTEGER) AS total_columns_checked, "
        "CAST(coalesce(a.nd, 0) AS INTEGER) AS columns_drifted, "
        "coalesce(a.flagged, '') AS flagged, coalesce(a.directions, '') AS directions "
        f"FROM (SELECT DISTINCT table_name FROM ({tables_sql})) t LEFT JOIN ({agg}) a ON t.table_name = a.table_name"
    )


# ----------------------------------------------------------------------------- quality

def first_failure(source: str, rules: Sequence[tuple[str, str]]) -> str:
    """Rows of ``source`` plus failure_reason = name of the first failing row rule."""
    cases = ", ".join(f"CASE WHEN {pred} THEN {q(name)} END" for name, pred in rules)
    reason = f"coalesce({cases})" if len(rules) > 1 else cases
    return f"SELECT *, {reason} AS failure_reason FROM ({source})"


def then_duplicates(tagged: str, name: str, keys: Sequence[str], order_by: Sequence[str]) -> str:
    """Duplicate rule applied after earlier reasons: only survivors compete."""
    part = ", ".join(f'"{k}"' for k in keys)
    order = ", ".join(f'"{o}"' for o in order_by)
    return (
        "SELECT * REPLACE (coalesce(failure_reason, CASE WHEN row_number() OVER "
        f"(PARTITION BY {part}, failure_reason IS NULL ORDER BY {order}) > 1 THEN {q(name)} END) "
        f"AS failure_reason) FROM ({tagged})"
    )
