"""Category comparison of two loads of a column (JN5, TOPK1).

Counts per value of both loads are one map-side combined aggregate, written once. The
top-k picks use ``orderBy(...).limit(k)``, which Spark plans as a per-task top-k followed
by one merge of k rows per task, so no task ever sees all values; the picked rows carry their
counts, and "Others" is the totals less the picked rows, so nothing is joined with all values.
Only the final handful of rows (at most ``max_categories``, or ``keep`` + Others) is ranked
by a window without partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftgate.functions.columns import ref
from driftgate.session import written

# Fixed values that must equal the reference's chart rule: more than 8 categories over
# both loads -> top 4 of each load, first 5 of those in that order, rest as "Others".
MAX_CATEGORIES = 8
TOP_EACH = 4
KEEP = 5
OTHERS = "Others"


def category_counts(baseline: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """(value, baseline_count, current_count) over the values of both loads (JN5).

    One grouped count over the union of both loads (side flag per row) instead of a full
    outer join of two counts: a single exchange, which every later branch reuses.
    """
    side = lambda df, s: df.select(ref(column).cast("string").alias("value"), F.lit(s).alias("_s"))
    u = side(baseline, 0).unionByName(side(current, 1))
    return u.groupBy("value").agg(
        F.count_if(F.col("_s") == 0).alias("baseline_count"),
        F.count_if(F.col("_s") == 1).alias("current_count"),
    )


def _top(counts: DataFrame, count_col: str, k: int, offset: int) -> DataFrame:
    top = counts.filter(F.col(count_col) > 0).orderBy(F.col(count_col).desc(), F.col("value").asc()).limit(k)
    w = Window.orderBy(F.col(count_col).desc(), F.col("value").asc())
    return top.select("value", "baseline_count", "current_count", (F.row_number().over(w) + F.lit(offset)).alias("pick"))


def category_comparison(
    baseline: DataFrame,
    current: DataFrame,
    column: str,
    max_categories: int = MAX_CATEGORIES,
    top_each: int = TOP_EACH,
    keep: int = KEEP,
) -> DataFrame:
    """(position, category, baseline_count, current_count) as the comparison chart shows it.

    At most ``max_categories`` values over both loads: every value, sorted. More: the
    top ``top_each`` of the baseline then of the current load (count desc, value asc),
    first ``keep`` distinct of those in that order, the rest summed as "Others" (only
    when there is a rest).
    """
    counts = written(category_counts(baseline, current, column), "category_counts")
    pair = ["baseline_count", "current_count"]
    totals = counts.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in pair])
    many = totals.select(F.col("n") > max_categories).scalar()
    picks = (
        _top(counts, "baseline_count", top_each, 0)
        .unionByName(_top(counts, "current_count", top_each, top_each))
        .groupBy("value")
        .agg(F.min("pick").alias("pick"), *[F.first(c).alias(c) for c in pair])
        .orderBy("pick")
        .limit(keep)
    )
    # every value if there are few (a limit above their number takes all of them)
    every = counts.orderBy("value").limit(max_categories).filter(~many)
    chosen = every.select("value", *pair, F.lit(None).cast("int").alias("pick")).unionByName(picks.select("value", *pair, "pick").filter(many))
    rest = totals.select("n", *pair).unionByName(picks.select(F.lit(-1).cast("long").alias("n"), *[(-F.col(c)).alias(c) for c in pair]))
    left = rest.agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in pair]).filter(many & (F.col("n") > 0))
    others = left.select(F.lit(OTHERS).alias("value"), *pair, F.lit(None).cast("int").alias("pick"), F.lit(True).alias("_others"))
    rows = chosen.withColumn("_others", F.lit(False)).unionByName(others)
    order = Window.orderBy(F.col("_others").asc(), F.col("pick").asc_nulls_last(), F.col("value").asc())
    return rows.select(
        F.row_number().over(order).cast("int").alias("position"),
        F.col("value").alias("category"),
        F.col("baseline_count").cast("long").alias("baseline_count"),
        F.col("current_count").cast("long").alias("current_count"),
    )
