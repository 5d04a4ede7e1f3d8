"""Quality rules as a learned decision list, in DataFrame functions only.

Statistics of every whole text are built-in expressions on its arrays of words and lines. A
decision list is learned from labelled documents by sequential covering: a rule starts empty and
grows by the threshold condition with the best information gain on the growing rows, is pruned
to the prefix that does best on the held-out pruning rows, is accepted if it is precise enough
there, and the rows it covers are set aside before the next rule grows. The result is an ordered
Spark conditional expression: the first rule that fits rejects, and a text that none fits is kept.

Learning reads the statistics table only: every step is one grouped count per (feature, bin),
so at most features x bins rows reach the driver, however many documents are labelled.

Defined results: null and empty texts have no words and fail the base rule; a ratio whose
denominator is zero is zero; repeated rows are judged alike; a label on several rows of one id
counts as bad if any is; without labels (or an empty label table) the list is empty and the base rule
alone decides; an empty table gives an empty result. Other columns stay as they are (the
prefix ``__dg_`` is reserved).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.llm.common import words
from driftgate.session import written

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
BINS = 32
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9
MIN_COVERED = 5
#: Ids of labelled documents are broadcast up to this many.
BROADCAST_IDS = 1_000_000

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks"]


#: The interpretable features that conditions may use: one count over another.
FEATURES = {
    "symbols per word": ("n_symbols", "n_words"),
    "marks per word": ("n_marks", "n_words"),
    "capitals per character": ("n_upper", "word_chars"),
    "digits per character": ("n_digits", "word_chars"),
    "characters per word": ("word_chars", "n_words"),
    "distinct words per word": ("n_distinct_words", "n_words"),
    "repeated words per word": ("n_repeat_words", "n_words"),
    "repeated lines per line": ("n_dup_lines", "n_lines"),
}


def feature(name: str) -> Column:
    top, bottom = FEATURES[name]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus the counts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    w = REPEAT_WINDOW
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"__dg_words": words(F.col(text_col)), "__dg_lines": lines})
    out = out.withColumns({"__dg_word_hashes": F.transform("__dg_words", lambda x: F.xxhash64(x)), "n_words": F.size("__dg_words").cast("long")})
    windows = F.expr(f"transform(sequence(1, n_words - {w - 1}), i -> xxhash64(slice(__dg_word_hashes, i, {w})))")
    out = out.withColumn("__dg_windows", F.when(F.col("n_words") >= w, windows).otherwise(F.array().cast("array<bigint>")))
    # Only texts in which some window comes twice sort their windows; positions next to an equal
    # neighbour are repeated ones, and each covers what the one before it has not.
    out = out.withColumn("__dg_sorted", F.when(
        F.size(F.array_distinct("__dg_windows")) < F.size("__dg_windows"),
        F.expr("array_sort(transform(__dg_windows, (h, i) -> struct(h, i)))"),
    ))
    out = out.withColumn("__dg_repeats", F.expr(
        "array_sort(transform(filter(sequence(0, size(__dg_sorted) - 1), j -> coalesce(get(__dg_sorted, j).h = get(__dg_sorted, j - 1).h, false)"
        " or coalesce(get(__dg_sorted, j).h = get(__dg_sorted, j + 1).h, false)), j -> get(__dg_sorted, j).i))"
    ))
    covered = F.expr(f"aggregate(__dg_repeats, named_struct('n', 0L, 'last', {-w}), (a, p) -> named_struct('n', a.n + least({w}, p - a.last), 'last', p), a -> a.n)")
    count = lambda keep: F.char_length(F.regexp_replace(text, keep, "")).cast("long")
    out = out.withColumns({
        "word_chars": F.char_length(F.array_join("__dg_words", "")).cast("long"),
        "n_symbols": count(r"[^#*$%&|<>]+"),
        "n_dup_lines": (F.size("__dg_lines") - F.size(F.array_distinct("__dg_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "n_lines": F.size("__dg_lines").cast("long"),
        "n_distinct_words": F.size(F.array_distinct("__dg_word_hashes")).cast("long"),
        "n_upper": count(r"\P{Lu}+"),
        "n_digits": count(r"[^0-9]+"),
        "n_marks": count(r"[^!?]+"),
    })
    return out.select(*docs.columns, *_COUNTS, *_MORE)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def rejected_by(rules: list[Rule]) -> Column:
    """The text of the first rule that fits, else null: the list as one conditional expression."""
    out = None
    for rule in rules:
        out = F.when(rule.column(), str(rule)) if out is None else out.when(rule.column(), str(rule))
    return F.lit(None).cast("string") if out is None else out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """FOIL's information gain of narrowing (p0 bad, n0 good) to (p, n)."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def bin_of(column: str, cuts: list[float]) -> Column:
    """How many of the sorted cuts are at or below the value."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.lit(cuts).cast("array<double>"), lambda cut: cut <= F.col(column)))


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> list[Rule]:
    """Learn the rules that reject label 0 from all labelled rows of ``stats`` (the columns of
    ``with_statistics``) that pass the base rule."""
    truth = labels.groupBy(F.col(id_col).alias("__dg_id")).agg((F.min(label_col) == 0).alias("__dg_bad")).filter("__dg_bad is not null")
    rows = stats.filter(~base_failed()).join(truth, F.col(id_col) == F.col("__dg_id"))
    names = list(FEATURES)
    rows = written(
        rows.select("__dg_bad", (F.pmod(F.xxhash64("__dg_id"), F.lit(3)) == 0).alias("__dg_prune"), *[feature(name).alias(f"__dg_f{i}") for i, name in enumerate(names)]),
        "labelled",
    )
    # Thresholds: quantiles of each class, so that a rare class has its own.
    steps = F.array(*[F.lit((i + 0.5) / BINS) for i in range(BINS)])
    marks = rows.groupBy("__dg_bad").agg(*[F.percentile_approx(f"__dg_f{i}", steps, 10000).alias(f"q{i}") for i in range(len(names))]).collect()
    cuts = [sorted({x for row in marks for x in row[f"q{i}"] or []}) for i in range(len(names))]
    binned = written(
        rows.select(
            F.col("__dg_bad").alias("bad"), F.col("__dg_prune").alias("prune"),
            F.array(*[
                bin_of(f"__dg_f{i}", c) for i, c in enumerate(cuts)
            ]).alias("bins"),
        ).groupBy("bad", "prune", "bins").agg(F.count("*").alias("n")),
        "binned",
    )

    def holds(bound: tuple[int, bool, int]) -> Column:  # bin b is at or above cut b - 1
        i, at_least, cut = bound
        return F.col("bins")[i] > cut if at_least else F.col("bins")[i] <= cut

    def counted(left: DataFrame) -> dict[tuple[int, bool, int], list[int]]:
        """For each condition: bad and good covered of the growing rows, then of the pruning rows."""
        cells = left.select(F.posexplode("bins").alias("i", "bin"), "bad", "prune", "n").groupBy("i", "bin", "bad", "prune").agg(F.sum("n").alias("n"))
        table = {(r.i, r.bin, r.prune, r.bad): r.n for r in cells.collect()}  # features x bins x 4 at most
        out = {}
        for i, c in enumerate(cuts):
            for cut in range(len(c)):
                for at_least in (True, False):
                    bins = range(cut + 1, len(c) + 1) if at_least else range(cut + 1)
                    out[i, at_least, cut] = [sum(table.get((i, b, prune, bad), 0) for b in bins) for prune in (False, True) for bad in (True, False)]
        everything = [sum(n for (i, _, p, y), n in table.items() if (i, p, y) == (0, prune, bad)) for prune in (False, True) for bad in (True, False)]
        return out | {(-1, True, 0): everything}

    rules: list[Rule] = []
    left = binned
    while len(rules) < MAX_RULES:
        grown: list[tuple[tuple[int, bool, int], list[int]]] = []
        inside = left
        while len(grown) < MAX_CONDITIONS:
            covers = counted(inside)
            p0, n0, *_ = covers.pop((-1, True, 0))
            if not p0 or not n0:
                break
            best = max(covers, key=lambda k: (_gain(*covers[k][:2], p0, n0), -k[0], k[1], -k[2]), default=None)
            if best is None or _gain(*covers[best][:2], p0, n0) <= 0:
                break
            grown.append((best, covers[best]))
            inside = inside.filter(holds(best))
        # Prune to the prefix with the best (p - n) / (p + n) on the pruning rows, shortest first.
        worth = [(p - n) / (p + n) if p + n else -1.0 for _, (_, _, p, n) in grown]
        if not grown:
            break
        keep = worth.index(max(worth)) + 1
        p1, n1, p2, n2 = grown[keep - 1][1]
        if p1 + p2 < MIN_COVERED or not p2 or p2 / (p2 + n2) < MIN_PRECISION or p1 / (p1 + n1) < MIN_PRECISION:
            break
        bounds = [b for b, _ in grown[:keep]]
        rules.append(Rule(tuple(Condition(names[i], at_least, cuts[i][cut]) for i, at_least, cut in bounds)))
        fits = F.lit(True)
        for b in bounds:
            fits = fits & holds(b)
        left = left.filter(~fits)
    return rules


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the counts, base_failed, kept and the rule that rejected it."""
    stats = written(with_statistics(docs.select(F.col(id_col), F.col(text_col)), text_col).drop(text_col), "statistics")
    rule = rejected_by(learn(stats, labels, id_col))
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", F.when(~F.col("base_failed"), rule))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).select(id_col, *_COUNTS, "base_failed", "kept", "rule")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that pass, all columns as they are. Texts are never shuffled: the labelled ones are
    read to learn (picked by a broadcast of their ids if there are at most ``BROADCAST_IDS``, else
    the statistics of all texts are taken), then all are read to be judged."""
    thin = docs.select(F.col(id_col).alias("__dg_id"), F.col(text_col).alias("__dg_text"))
    known = labels.select(F.col(id_col).alias("__dg_known")).filter("__dg_known is not null").distinct()
    if known.count() <= BROADCAST_IDS:
        thin = thin.join(F.broadcast(known), F.col("__dg_id") == F.col("__dg_known"), "left_semi")
    learning = written(with_statistics(thin, "__dg_text").drop("__dg_text").withColumnRenamed("__dg_id", id_col), "statistics")
    rules = learn(learning, labels, id_col)
    judged = docs.select(F.struct(*docs.columns).alias("__dg_row"), F.col(text_col).alias("__dg_text"))
    # A filter on the statistics would be pushed below them, computing them anew for every use; a
    # generated row (none for a rejected text) is not.
    good = F.when(~base_failed() & rejected_by(rules).isNull(), F.array("__dg_row"))
    kept = with_statistics(judged, "__dg_text").select(F.explode_outer(good).alias("__dg_row"))
    return kept.filter(F.col("__dg_row").isNotNull()).select("__dg_row.*")
