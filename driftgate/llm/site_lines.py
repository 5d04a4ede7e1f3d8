"""Line dedup by site-relative frequency, in DataFrame functions only.

A line is boilerplate of a host if the share of the host's pages that contain it exceeds ``RATIO``. Pages
with the line are divided by the host's page total; so that a host of any size is treated alike,
without a floor on its pages, the share is taken over a page's *other* pages (the page itself says
nothing about repetition) and its lower confidence bound (Wilson, ``Z``) is compared: three pages
out of four tell as much as the bound says. A host's only page keeps all its lines, nine pages
with one footer lose it. All pages count; with ``once`` pages with equal lines count once,
so that a group of copies does not turn a page's own text into boilerplate.

Lines are cut at ``\n`` and compared whole, by 64-bit hash. Lines travel as hashes; a hot host
is counted by (host, line) with partial sums and its totals by partial sums, so no group is
gathered. What is gathered per host are its boilerplate lines, at most (lines per page) / ratio. They are
written, and broadcast to the texts if there are at most ``BROADCAST_LINES``; beyond that the
texts are joined by (host, one of ``SALTS`` numbers), the lists repeated for each number.

Defined results: a line without a word is kept and not counted; a null text stays null, an empty
one empty; a null host is a host of its own; repeated rows are treated alike; a text that is
boilerplate throughout becomes empty; an empty table gives an empty result. Other columns stay
as they are (the prefix ``__dg_`` is reserved).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.session import written

#: Over all hosts of the given tables the most frequent line is on 0.085 of a host's pages or more, every
#: other line on 0.046 at most; the ratio lies between.
RATIO = 0.065
Z = 1.96
#: Lists of boilerplate lines are broadcast up to this many lines, 8 bytes each.
BROADCAST_LINES = 1_000_000
SALTS = 32

_HAS_WORD = r"[^\x20\x09-\x0D]"


def lower_bound(pages: Column, total: Column, z: float = Z) -> Column:
    """Lower end of the Wilson interval of the share ``(pages - 1) / (total - 1)``."""
    n = total.cast("double") - 1.0
    p = (pages.cast("double") - 1.0) / n
    zz = z * z
    return (p + zz / (n * 2.0) - F.sqrt(p * (1.0 - p) / n + zz / (n * n * 4.0)) * z) / (zz / n + 1.0)


def boilerplate(docs: DataFrame, host_col: str, text_col: str, ratio: float = RATIO, once: bool = False) -> DataFrame:
    """Rows (host, n_pages, lines): the hashes of each host's boilerplate lines."""
    lines = F.transform(F.filter(F.split(text_col, "\n"), lambda x: x.rlike(_HAS_WORD)), lambda x: F.xxhash64(x))
    pages = docs.filter(F.col(text_col).isNotNull()).select(F.col(host_col).alias("host"), lines.alias("lines"))
    pages = pages.distinct() if once else pages
    totals = pages.groupBy("host").agg(F.count("*").alias("n_pages"))
    found = (
        pages.select("host", F.explode(F.array_distinct("lines")).alias("line"))
        .groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    )
    joined = found.alias("f").join(totals.alias("t"), F.col("f.host").eqNullSafe(F.col("t.host")))
    over = joined.filter(lower_bound(F.col("n"), F.col("n_pages")) > ratio)
    return over.groupBy("f.host").agg(F.first("n_pages").alias("n_pages"), F.collect_set("line").alias("lines"))


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, once: bool = False, lines_col: str | None = None, dropped_col: str | None = None) -> DataFrame:
    """``docs`` with the boilerplate lines gone from ``text_col`` and, where names are given, columns
    with the number of lines and of dropped lines."""
    found = written(boilerplate(docs, host_col, text_col, ratio, once), "boilerplate")
    found = found.select(F.col("host").alias("__dg_host"), F.col("lines").alias("__dg_lines"))
    n_found = found.agg(F.sum(F.size("__dg_lines"))).first()[0] or 0
    same = docs[host_col].eqNullSafe(F.col("__dg_host"))
    if n_found <= BROADCAST_LINES:
        marked = docs.join(F.broadcast(found), same, "left")
    else:
        salted = docs.withColumn("__dg_salt", F.pmod(F.xxhash64(text_col), F.lit(SALTS)))
        spread = found.withColumn("__dg_number", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        marked = salted.join(spread, same & (F.col("__dg_salt") == F.col("__dg_number")), "left")
    all_lines = F.split(docs[text_col], "\n")
    keeps = F.filter(all_lines, lambda x: ~F.array_contains("__dg_lines", F.xxhash64(x)) | ~x.rlike(_HAS_WORD))
    marked = marked.withColumn("__dg_kept", F.when(F.col("__dg_lines").isNotNull(), keeps))
    text = F.when(F.col("__dg_kept").isNull(), F.col(text_col)).otherwise(F.array_join("__dg_kept", "\n"))
    columns = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(all_lines)).cast("long")
    if lines_col:
        columns.append(n_lines.alias(lines_col))
    if dropped_col:
        columns.append(F.when(F.col("__dg_kept").isNull(), 0).otherwise(n_lines - F.size("__dg_kept")).cast("long").alias(dropped_col))
    return marked.select(*columns)
