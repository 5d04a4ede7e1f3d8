"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base spans come from four patterns (e-mail, IP address, card, phone), each leftmost and
non-overlapping, checked by value (parts up to 255, Luhn, number of digits); a failing match is dropped.
They are the seed entities. Every other word with a digit is an unknown candidate, if it has at
least ``MIN_LENGTH`` characters and ``MIN_DIGITS`` digits without outer punctuation and touches no base span.

Seeds and candidates stand in lexical patterns: the word before, the two words before, and the word
before with the word behind. Words with a digit count as ``#`` there, a text's border as ``^``, A-Z as a-z,
and a gap's words are taken from its last (first) ``CONTEXT`` characters. Patterns and instances (kind and
value) form a graph that is scored in ``ROUNDS`` rounds, in millionths, with whole numbers:

* confidence of a pattern for a kind: the scores of its instances of that kind (a seed 1) over its
  number of instances plus one; a pattern is strong with scores of ``SUPPORT`` and a confidence of
  ``CONFIDENCE`` at least;
* score of a candidate for a kind: one minus the product of (1 - confidence) over the strong patterns it
  stands in.

A candidate with a score of ``ACCEPT`` is an identifier of that kind (the best scored, then the first
listed), wherever it stands in one of that kind's strong patterns; it joins the spans under
the seed's kind. Counts and ``base_spans`` hold base spans only.

Texts are scanned once; what goes on is one row a match, keyed by a row number, so texts are never
shuffled. Edges are distinct (pattern, kind, value) rows, counted map-side before their shuffle, so
a pattern or value that holds a third of all matches is one row a task. Strong patterns are broadcast
only if there are at most ``BROADCAST_ROWS``; beyond that they are joined by shuffle.

Defined results: a null text is empty; repeated rows and null ids keep a result row each; an empty
table gives no rows; further columns are ignored. Offsets are code points. The patterns are written
so that a run of any length is read once: a match starts at a run's start or at the last match's end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftgate.session import written

#: Kinds in the order of the listing.
KINDS = ("email", "ip", "card", "phone")
# Fixed values of the contract: the patterns, with possessive repeats where nothing behind could take part.
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
MAX_PART, CARD_DIGITS, PHONE_DIGITS = 255, (16, 19), (8, 15)

SPACE = r"\x20\x09-\x0D"
#: A word with a digit.
CANDIDATE = rf"(?<![^{SPACE}])[^{SPACE}0-9]*+[0-9][^{SPACE}]*+"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_LENGTH, MIN_DIGITS = 5, 3
CONTEXT = 128
ROUNDS = 3
SUPPORT, CONFIDENCE, ACCEPT = 3, 0.6, 0.7
#: 24 bytes a row.
BROADCAST_ROWS = 1_000_000
_ONE = 1_000_000
_UNKNOWN = len(KINDS)


def _low(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _words(part: Column) -> Column:
    """Words of a short text, lower-case, those with a digit as ``#``."""
    found = F.filter(F.split(_low(part), f"[{SPACE}]+"), lambda w: w != "")
    return F.transform(found, lambda w: F.when(w.rlike("[0-9]"), "#").otherwise(w))


def _tail(gap: Column) -> Column:
    """The last two words of a gap, the last first."""
    return F.slice(F.reverse(_words(F.substring(gap, -CONTEXT, CONTEXT))), 1, 2)


def _scan(text: Column, pattern: str, kind: int) -> Column:
    """One struct per gap between matches with the match behind it (the last: none)."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    row = lambda gap, hit: F.struct(
        F.lit(kind).alias("kind"),
        F.length(gap).cast("long").alias("gap"),
        _tail(gap).alias("tail"),
        F.get(_words(F.substring(gap, 1, CONTEXT)), F.lit(0)).alias("head"),
        hit.alias("hit"),
    )
    return F.zip_with(gaps, hits, row)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a short digit string has a Luhn sum divisible by ten."""
    figures = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: Column, hit: Column) -> Column:
    digits = _digits(hit)
    n = F.length(digits)
    parts_fit = F.forall(F.split(hit, "\\."), lambda p: F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).cast("int") <= MAX_PART).otherwise(False))
    return (
        F.when(hit.isNull(), False)
        .when(kind == 0, True)
        .when(kind == 1, parts_fit)
        .when(kind == 2, F.when(n.between(*CARD_DIGITS), _luhn(digits)).otherwise(False))
        .when(kind == 3, n.between(*PHONE_DIGITS))
        .otherwise(False)
    )


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, kind, at, gap, tail, head, hit): written, one row per gap of a kind with matches, and one
    row without a kind for a text that has none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digit = text.rlike("[0-9]")
    guards = (F.contains(text, F.lit("@")), digit, digit, F.contains(text, F.lit("+")), digit)
    scans = [F.when(g, _scan(text, p, k)) for k, (p, g) in enumerate(zip((*PATTERNS, CANDIDATE), guards, strict=True))]
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), *[s.alias(f"s{k}") for k, s in enumerate(scans)])
    some = [F.when(F.size(f"s{k}") > 1, F.col(f"s{k}")).otherwise(F.array()) for k in range(len(scans))]
    rows = found.select("row", "id", F.posexplode_outer(F.concat(*some)).alias("at", "m"))
    return written(rows.select("row", "id", "m.kind", "at", "m.gap", "m.tail", "m.head", "m.hit"), "pii_matches")


def occurrences(found: DataFrame) -> DataFrame:
    """(row, id, kind, start, end, value, patterns): written; ``kind`` is null in rows that only keep a
    text's row, and len(KINDS) for a candidate."""
    scan = Window.partitionBy("row", "kind").orderBy("at")
    before = scan.rowsBetween(Window.unboundedPreceding, 0)
    size = F.coalesce(F.length("hit"), F.lit(0)).cast("long")
    border = F.when(F.row_number().over(scan) == 1, "^").otherwise("#")
    placed = found.repartition("row").withColumns({
        "end": F.sum(F.col("gap") + size).over(before),
        "behind": F.coalesce(F.lead("head").over(scan), F.when(F.lead("hit").over(scan).isNull(), "^").otherwise("#")),
        "w1": F.coalesce(F.get("tail", F.lit(0)), border),
        "w2": F.coalesce(F.get("tail", F.lit(1)), F.when(F.size("tail") == 0, "").otherwise(border)),
    })
    # a candidate without its outer punctuation
    unknown = F.col("kind") == _UNKNOWN
    bare = F.ltrim("hit", F.lit(PUNCTUATION))
    trimmed = placed.withColumns({
        "start": F.col("end") - F.when(unknown, F.length(bare)).otherwise(F.length("hit")),
        "value": _low(F.when(unknown, F.rtrim(bare, F.lit(PUNCTUATION))).otherwise(F.col("hit"))),
    })
    trimmed = trimmed.withColumns({
        "end": F.when(unknown, F.col("start") + F.length("value")).otherwise(F.col("end")),
        "ok": F.when(unknown, (F.length("value") >= MIN_LENGTH) & (F.length(_digits(F.col("value"))) >= MIN_DIGITS)).otherwise(_valid(F.col("kind"), F.col("hit"))),
    })
    # a candidate that touches a base span is no candidate
    base = F.col("ok") & ~unknown
    up = Window.partitionBy("row").orderBy("start", "at").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("row").orderBy(F.col("start").desc(), F.col("at")).rowsBetween(Window.unboundedPreceding, 0)
    apart = trimmed.withColumns({"reached": F.max(F.when(base, F.col("end"))).over(up), "next": F.min(F.when(base, F.col("start"))).over(down)})
    touched = (F.coalesce(F.col("reached"), F.lit(-1)) > F.col("start")) | (F.coalesce(F.col("next"), F.col("end")) < F.col("end"))
    keep = F.coalesce(F.col("ok"), F.lit(False)) & ~(unknown & touched)
    gap = F.lit("\x1f")
    patterns = F.array(
        F.xxhash64(F.lit(1), "w1"),
        F.xxhash64(F.lit(2), F.concat("w2", gap, "w1")),
        F.xxhash64(F.lit(3), F.concat("w1", gap, "behind")),
    )
    one_or_kept = keep | (F.row_number().over(Window.partitionBy("row").orderBy("at")) == 1)
    out = apart.withColumns({"keep": keep, "first": one_or_kept}).filter("first")
    only = lambda c: F.when(F.col("keep"), c)
    return written(
        out.select(
            "row", "id", only(F.col("kind")).alias("kind"), only(F.col("start")).alias("start"), only(F.col("end")).alias("end"),
            only(F.xxhash64("value")).alias("value"), only(patterns).alias("patterns"),
        ),
        "pii_occurrences",
    )


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def score(found: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """((pattern, kind, confidence) of strong patterns, (value, kind, score) of accepted candidates)."""
    edges = found.filter(F.col("kind").isNotNull()).select(F.explode("patterns").alias("pattern"), F.col("kind").alias("known"), "value").distinct()
    edges = written(edges, "pii_edges")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    seeds = edges.filter(F.col("known") < _UNKNOWN).groupBy("pattern", F.col("known").alias("kind")).agg((F.count(F.lit(1)) * _ONE).alias("points"))
    unknown = edges.filter(F.col("known") == _UNKNOWN).select("pattern", "value")
    # A pattern without a seed or a scored candidate cannot be strong: only those that can are sized.
    points = seeds
    for i in range(rounds):
        total = points.groupBy("pattern", "kind").agg(F.sum("points").alias("points")).filter(F.col("points") >= SUPPORT * _ONE)
        confidence = F.expr("points div (n + 1)")
        strong = total.join(sizes, "pattern").select("pattern", "kind", confidence.alias("confidence")).filter(F.col("confidence") >= int(CONFIDENCE * _ONE))
        strong = written(strong, "pii_patterns")
        weight = F.round(-F.log(F.lit(1.0) - F.col("confidence") / float(_ONE)) * _ONE).cast("long")
        scored = unknown.join(_small(strong), "pattern").groupBy("value", "kind").agg(F.sum(weight).alias("weight"))
        scored = scored.select("value", "kind", F.floor((F.lit(1.0) - F.exp(-F.col("weight") / float(_ONE))) * _ONE).alias("score"))
        scored = written(scored, "pii_scores")
        if i + 1 < rounds:
            points = seeds.unionByName(unknown.join(_small(scored), "value").select("pattern", "kind", F.col("score").alias("points")))
    order = F.max_by("kind", F.struct("score", -F.col("kind")))
    best = scored.filter(F.col("score") >= int(ACCEPT * _ONE)).groupBy("value").agg(order.alias("kind"), F.max("score").alias("score"))
    return strong, written(best, "pii_accepted")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document row: id, n_email, n_ip, n_card, n_phone, base_spans, n_found, spans, the spans as
    ``kind:start:end`` by kind, then start, comma-joined."""
    found = occurrences(matches(docs, id_col, text_col))
    strong, accepted = score(found, rounds)
    candidates = found.filter(F.col("kind") == _UNKNOWN).select("row", "id", "start", "end", "value", F.explode("patterns").alias("pattern"))
    new = (
        candidates.join(_small(accepted.select("value", "kind")), "value")
        .join(_small(strong.select("pattern", "kind")), ["pattern", "kind"], "left_semi")
        .select("row", "id", "kind", "start", "end", F.lit(False).alias("base"))
        .distinct()
    )
    base = found.select("row", "id", F.when(F.col("kind") < _UNKNOWN, F.col("kind")).alias("kind"), "start", "end", F.lit(True).alias("base"))
    span = F.struct("kind", "start", "end")
    known = F.col("kind").isNotNull()
    counts = [F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    rows = base.unionByName(new).groupBy("row").agg(
        F.first("id").alias("id"), *counts,
        F.sort_array(F.collect_list(F.when(F.col("base") & known, span))).alias("b"),
        F.sort_array(F.collect_list(F.when(known, span))).alias("s"),
        F.count_if(~F.col("base")).alias("n_found"),
    )
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", name(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    return rows.select(F.col("id").alias(id_col), *[f"n_{k}" for k in KINDS], joined(F.col("b")).alias("base_spans"), "n_found", joined(F.col("s")).alias("spans"))
