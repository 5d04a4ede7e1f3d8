"""Property tests against brute force on small random inputs (hypothesis)."""

from __future__ import annotations

import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from driftgate.functions import rules as R
from driftgate.operators import quality
from driftgate.operators.profile import profile

ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),  # key, with NULLs
        st.integers(min_value=0, max_value=5),  # order value, with ties
        st.sampled_from([-1.0, 0.0, 1.0, None]),  # value checked by an earlier rule
    ),
    min_size=0,
    max_size=40,
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=ROWS, parts=st.integers(min_value=1, max_value=6), shuffled=st.booleans())
def test_duplicate_rule_matches_brute_force(spark, rows, parts, shuffled):
    data = [(i, k, o, x) for i, (k, o, x) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, k string, o int, x double").repartition(parts)
    if shuffled:
        df = df.repartition(parts, "o")
    out = quality.evaluate(df, [R.positive("x"), R.no_duplicates("k", "o")])
    got = {r.id: r.failure_reason for r in out.tagged.select("id", "failure_reason").collect()}

    # Brute force: earlier rule first; then per key, among survivors, all but one of the
    # rows with the smallest order value (ties broken arbitrarily) and all larger ones fail.
    first_fail = {i: ("x_positive" if (x is None or x <= 0) else None) for i, _, _, x in data}
    survivors = [(i, k, o) for i, k, o, _ in data if first_fail[i] is None]
    by_key: dict = {}
    for i, k, o in survivors:
        by_key.setdefault(k, []).append((o, i))
    assert Counter(v for v in got.values()) == Counter(
        list(v for v in first_fail.values() if v) + ["k_unique"] * sum(len(v) - 1 for v in by_key.values()) + [None] * len(by_key)
    )
    for k, members in by_key.items():
        kept = [i for _, i in members if got[i] is None]
        assert len(kept) == 1
        assert min(o for o, _ in members) == next(o for o, i in members if i == kept[0])
    assert out.clean.count() + out.quarantine.count() == len(data)


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.integers(min_value=-3, max_value=3)), min_size=0, max_size=60))
def test_entropy_matches_direct_formula(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    r = profile(df, exclude_columns=[]).collect()[0]
    n = len(values)
    counts = Counter(values)
    direct = 0.0 if len(counts) <= 1 else round(-sum(c / n * math.log2(c / n) for c in counts.values()), 6)
    assert r.total_count == n and r.distinct_count == len(counts) and r.null_count == values.count(None)
    assert abs(r.entropy - direct) <= 1e-6
