"""driftgate: entropy profiles, drift and release gates on Spark DataFrames.

The public surface, re-exported for convenience; every function takes and returns
DataFrames (see the README for the full operator map).
"""

from driftgate.functions import rules
from driftgate.operators.baseline import latest_baseline
from driftgate.operators.compare import category_comparison, category_counts
from driftgate.operators.drift import column_drift, drifted_ratio, table_health, unmatched_columns
from driftgate.operators.fidelity import fidelity, row_fidelity, schema_diff
from driftgate.operators.gates import evaluate_gates, run_metrics, verdicts
from driftgate.operators.ledger import build_ledger, provenance_coverage
from driftgate.operators.profile import column_entropy, profile, profile_tables, value_frequencies
from driftgate.operators.quality import evaluate as evaluate_quality
from driftgate.plans.release import release_control, release_many, release_stored
from driftgate.sources.readers import gates_frame, read_config, read_csv_strings, thresholds_frame
from driftgate.sources.sinks import capture_baseline, log_measurement

__all__ = [
    "rules",
    "latest_baseline",
    "category_comparison",
    "category_counts",
    "column_drift",
    "drifted_ratio",
    "table_health",
    "unmatched_columns",
    "fidelity",
    "row_fidelity",
    "schema_diff",
    "evaluate_gates",
    "run_metrics",
    "verdicts",
    "build_ledger",
    "provenance_coverage",
    "column_entropy",
    "profile",
    "profile_tables",
    "value_frequencies",
    "evaluate_quality",
    "release_control",
    "release_many",
    "release_stored",
    "gates_frame",
    "read_config",
    "read_csv_strings",
    "thresholds_frame",
    "capture_baseline",
    "log_measurement",
]
