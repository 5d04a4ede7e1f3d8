"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

job per column and statistic (1 + 7*C actions). ``profile_lineitem_column_loop`` restates
that shape with the same session; ``profile_lineitem_onepass`` is ours. Each query runs once
to warm up, then three times; the median is reported. Results are forced with the
``noop`` sink, so the whole plan runs without collecting rows to the driver.
``spark_jobs`` reports how many Spark jobs one run of each query takes (the structural
yardstick: 4 for the one-pass lineitem profile against 1 + 7*C actions for the loop).
"""

from __future__ import annotations

import json
import math
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from driftgate.functions import rules as R  # noqa: E402
from driftgate.operators import drift, quality  # noqa: E402
from driftgate.operators.profile import profile  # noqa: E402
from driftgate.plans import catalogue as C  # noqa: E402
from driftgate.plans import catalogue_runs as CR  # noqa: E402
from driftgate.plans import fixtures as fx  # noqa: E402
from driftgate.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = 3


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def column_loop_profile(df) -> list[dict]:
    """The naive per-column shape the reference uses (restated here for comparison only)."""
    total = df.count()
    out = []
    for c in df.columns:
        def entropy():
            n = df.count()
            if n == 0:
                return 0.0
            rows = (
                df.select(F.col(c).cast("string").alias("v")).fillna({"v": "__NULL__"})
                .groupBy("v").agg(F.count("*").alias("f")).collect()
            )
            return round(-sum((r["f"] / n) * math.log2(r["f"] / n) for r in rows), 6)

        h = entropy()
        h2 = entropy()
        d = df.select(c).distinct().count()
        hn = round(h2 / math.log2(d), 6) if d > 1 else 0.0
        d2 = df.select(c).distinct().count()
        nulls = df.filter(F.col(c).isNull()).count()
        out.append(dict(column_name=c, entropy=h, normalized_entropy=hn, distinct_count=d2, null_count=nulls, total=total))
    return out


def main() -> None:
    spark = local_session(
        master=f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": str(CPUS), "spark.driver.memory": "16g"},
    )
    sf = SF_DIR
    lineitem = fx.table(spark, sf, "lineitem")

    def onepass():
        run(profile(lineitem, "lineitem", exclude_columns=[]))

    def loop():
        column_loop_profile(lineitem)

    def health_many():
        run(drift.table_health(*C._many_profiles(spark, sf)))

    def quality_lineitem():
        rules = [
            R.not_null("l_shipdate"),
            R.positive("l_quantity"),
            R.no_duplicates(["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]),
        ]
        out = quality.evaluate(lineitem, rules)
        run(out.tagged)

    def quality_results():
        rules = [R.not_null("l_shipdate"), R.positive("l_quantity"), R.no_duplicates("l_orderkey", "l_linenumber")]
        run(quality.evaluate(lineitem, rules).results)

    def release():
        run(CR.q_release_control(spark, sf))

    def gate_verdicts():
        run(CR.q_gate_verdict(spark, sf))

    def documents_dedup():
        run(C.q_rule_no_duplicates(spark, sf))

    plan = {
        "profile_lineitem_onepass": onepass,
        "profile_lineitem_column_loop": loop,
        "table_health_many": health_many,
        "quality_lineitem_tagged": quality_lineitem,
        "quality_lineitem_results": quality_results,
        "documents_dedup": documents_dedup,
        "release_control": release,
        "gate_verdicts": gate_verdicts,
    }
    timings, jobs = {}, {}
    sc = spark.sparkContext
    for name, fn in plan.items():
        sc.setJobGroup(f"bench-{name}", name)
        fn()  # warm-up; also counts the Spark jobs one run takes
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(f"bench-{name}"))
        sc.setJobGroup("bench-timed", "timed")
        samples = []
        for _ in range(REPEATS):
            t0 = time.perf_counter()
            fn()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {timings[name]}s (samples {[round(s, 3) for s in samples]})", file=sys.stderr, flush=True)

    sf_label = os.path.basename(os.path.normpath(sf)).replace("sf", "")
    speedup = timings["profile_lineitem_column_loop"] / max(timings["profile_lineitem_onepass"], 1e-9)
    print(
        json.dumps(
            {
                "metric": "profile_lineitem_onepass_sec",
                "value": timings["profile_lineitem_onepass"],
                "unit": "sec",
                "queries": timings,
                "speedup_vs_column_loop": round(speedup, 2),
                "spark_jobs": jobs,
                "sf": float(sf_label) if sf_label.replace(".", "").isdigit() else sf_label,
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
