"""Releases against baselines stored in a history."""

from driftgate.functions import rules as R
from driftgate.operators import drift
from driftgate.plans.catalogue import config_frame
from driftgate.plans.catalogue_runs import _CTX
from driftgate.plans.release import release_stored
from driftgate.sources import sinks


def test_release_against_stored_baselines(spark, tmp_path):
    old = spark.createDataFrame([(i, "abcd"[i % 4]) for i in range(80)], "k int, c string")
    collapsed = spark.createDataFrame([(i, "a") for i in range(80)], "k int, c string")
    target = str(tmp_path / "baselines")
    sinks.capture_baseline({"t": collapsed}, target, exclude_columns=["k"], measurement_ts="2024-01-01 00:00:00")
    sinks.capture_baseline({"t": old, "u": old}, target, exclude_columns=["k"], measurement_ts="2024-02-01 00:00:00")
    runs = [{**_CTX, "run_id": t, "table_name": t} for t in "tuv"]
    rel = release_stored(
        sinks.read_baselines(spark, target), {"t": old, "u": collapsed, "v": old}, config_frame(spark), runs,
        exclude_columns=["k"], rules={t: [R.not_null("c")] for t in "tuv"},
    )
    found = {r.run_id: (r.overall_verdict, r.unmeasured_gates) for r in rel.verdicts.collect()}
    assert found == {"t": ("PASS", []), "u": ("FAIL", []), "v": ("INCOMPLETE", ["FAIL-1", "FAIL-2", "WARN-5"])}
    assert {r.run_id: r.row_count_ratio for r in rel.fidelity.collect()} == {"t": 1.0, "u": 1.0}


def test_several_rows_of_one_column_newest_counts(spark):
    columns = "table_name string, column_name string, entropy double, measurement_ts timestamp"
    rows = spark.createDataFrame([("t", "c", 2.0, None), ("t", "c", 1.0, None)], columns)
    dated = spark.sql("SELECT 't' table_name, 'c' column_name, 2.0D entropy, timestamp'2024-01-01' measurement_ts "
                      "UNION ALL SELECT 't', 'c', 1.0D, timestamp'2024-01-02'")
    (row,) = drift.column_drift(dated, rows).collect()
    assert (row.baseline_entropy, row.current_entropy) == (1.0, 2.0)
    (load,) = drift.health_history(dated, dated.filter("entropy = 1.0")).collect()
    assert (load.total_columns_checked, load.health_score) == (1, 1.0)
