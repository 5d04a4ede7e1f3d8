"""Name -> (Spark query, DuckDB oracle) for every catalogue entry."""

from __future__ import annotations

from collections.abc import Callable

from driftgate.plans import catalogue as C
from driftgate.plans import catalogue_rows as CW
from driftgate.plans import catalogue_runs as CR

NAMES = [
    # profiles (AGG1-AGG7, PRJ1-PRJ4, SCL1, SRC1)
    "value_frequencies", "entropy_column", "normalized_entropy",
    "entropy_profile_orders", "entropy_profile_lineitem", "entropy_profile_customer",
    "entropy_profile_documents", "entropy_profile_many", "entropy_profile_nulls",
    "entropy_profile_excluded", "entropy_profile_empty", "csv_profile",
    # baselines and audit history (SNK1, SNK2, AGG17, PRJ8, SRC4)
    "baseline_capture", "audit_log", "latest_baseline",
    # drift and health (JN1, JN2, SCL2, SCL3, AGG8-AGG11)
    "column_drift", "column_drift_thresholds", "drift_unmatched_columns",
    "table_health", "table_health_weighted", "table_health_no_common", "table_health_many",
    "flagged_columns", "drifted_ratio", "health_history", "table_health_unrounded",
    # quality (QR1-QR5, WIN1, CMP1, AGG12, AGG18, SET1, SET2)
    "rule_not_null", "rule_positive", "rule_date_range", "rule_no_duplicates", "rule_custom",
    "rule_reference", "rule_rows", "quality_quarantine_empty",
    "quality_clean", "quality_quarantine", "quality_results", "quality_ratios",
    "quality_duplicates_midway", "quality_clean_set_semantics", "quarantine_union",
    # bronze and fidelity (SNK3-SNK5, PRJ5, AGG13, JN4, SET4, PRJ9)
    "bronze_materialize", "bronze_report", "fidelity", "catalog_profile",
    # gates, verdicts, ledger (SRC3, JN3, SCL4-SCL7, AGG14-AGG16, SNK6, CMP3)
    "gate_evaluations", "gate_unmeasured", "gate_labels", "gate_verdict", "publish_decision",
    "gate_details", "gate_nan", "gate_files",
    "provenance_coverage", "run_ledger",
    # comparison and simulation (JN5, TOPK1, PRJ10-PRJ12)
    "category_comparison", "category_comparison_others", "spot_checks", "simulated_drift",
    # end to end (CMP2, CMP4)
    "release_control", "release_control_healthy",
    # Structured Streaming: audit log per micro-batch (SNK2 per load cycle)
    "stream_audit_log",
]


def _lookup(prefix: str, name: str) -> Callable:
    for mod in (C, CR, CW):
        fn = getattr(mod, f"{prefix}_{name}", None)
        if fn is not None:
            return fn
    raise KeyError(f"{prefix}_{name}")


def queries() -> dict[str, Callable]:
    return {n: _lookup("q", n) for n in NAMES}


def oracle_sql() -> dict[str, str]:
    return {n: _lookup("sql", n)() for n in NAMES}
