"""SimHash near-duplicates with pigeonring candidate filtering.

A document's fingerprint has bit j set if over half of its word shingles' XXH64 values have it.
Two fingerprints link at ``max_bits`` or fewer differing bits. Candidates come from the
pigeonring principle: cut the bits into a ring of m equal segments; if two fingerprints differ
in at most t bits, some chain of consecutive segments exists whose first l segments together
differ in at most floor(l * t / m) bits, for every l up to m. With m = 4 and t = 3 that is: one
segment equal, it and the next differ in one bit at most, the three in two at most. The first
two lengths are an equi-join on 32 bits; the rest of the chain is checked on the joined pair
before the full Hamming distance.

Documents are grouped by fingerprint first, so a group of copies is one row whatever its size.

Defined results: a null or empty text, or one without words, has fingerprint zero and links like
any other; a text of fewer words than a shingle hashes its whole word sequence; repeated rows
get equal results, one each; a null id takes part in linking and gets the smallest non-null id
of its group (null if there is none); an empty table gives an empty result. Other columns of
the input are not touched, whatever their names (the prefix ``__dg_`` is reserved).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from driftgate.llm import common
from driftgate.operators import identity
from driftgate.session import written

SHINGLE_WORDS = 3
MAX_BITS = 3
SEGMENTS = 4  # of 16 bits; the join key is the first two of a chain
HASH_SEED = 42


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= shingle_words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, HASH_SEED)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        spans = zip((ends - lengths)[: n - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], HASH_SEED) for a, b in spans), np.uint64, n - shingle_words + 1)
    counts = np.zeros(64, np.int64)
    for part in np.array_split(hashes, max(1, len(hashes) // 65536)):  # bounds the bit matrix
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "__dg_fp", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """All columns of ``docs`` plus the fingerprint as a signed long."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t or b"", shingle_words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps)], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, LongType())]))


def candidate_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b), a < b, between distinct fingerprints (column ``fp``) at ``max_bits`` or
    fewer differing bits. ``max_bits`` of 3 or less: the ring's first segment must be equal."""
    if not 0 <= max_bits < SEGMENTS:
        raise ValueError("the equi-join on a chain's start needs max_bits below the number of segments")
    width = 64 // SEGMENTS
    budget = [(n * max_bits) // SEGMENTS for n in range(SEGMENTS + 1)]
    turned = F.explode(
        F.array(*[
            F.struct(
                F.lit(i).alias("i"),
                (F.shiftleft("fp", width * i).bitwiseOR(F.shiftrightunsigned("fp", 64 - width * i)) if i else F.col("fp")).alias("ring"),
            )
            for i in range(SEGMENTS)
        ])
    )
    rings = prints.select("fp", turned.alias("t")).select("fp", "t.ring", "t.i").withColumn(
        "key", F.shiftleft(F.col("i").cast("long"), 2 * width).bitwiseOR(F.shiftrightunsigned("ring", 2 * width))
    )
    # Of two second segments that differ in one bit, one has the bit set: clearing set bits on
    # one side meets the other side's own segment, so each such pair is found once.
    clear = "key"
    if budget[2] >= 1:
        clear = (
            f"explode(concat(array(key), transform(filter(sequence(0, {width - 1}), b -> (shiftright(key, b) & 1) = 1), "
            "b -> key - shiftleft(1L, b))))"
        )
    probes = rings.select(F.col("fp").alias("a"), F.col("ring").alias("ra"), F.expr(clear).alias("key"), F.col("key").alias("own"))
    index = rings.select(F.col("fp").alias("b"), F.col("ring").alias("rb"), "key")
    pairs = probes.join(index, "key").filter((F.col("a") < F.col("b")) | (F.col("own") != F.col("key")))
    differ = F.col("ra").bitwiseXOR(F.col("rb"))
    for n in range(2, SEGMENTS):
        pairs = pairs.filter(F.bit_count(F.shiftrightunsigned(differ, 64 - width * n)) <= budget[n])
    pairs = pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def connected(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): rows (node, root), root the smallest node. Nodes
    without a link are not listed. Alternating large-star and small-star rounds: neighbours'
    minima are plain aggregates, so a hub is combined map-side; every round is a written table."""
    edges = written(links.select("a", "b"), "links")
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")).select("e.a", F.col("e.m").alias("b"))
        after = written(small.filter("a <> b").distinct(), "links")
        same = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        if edges.agg(F.count("*"), same).first() == after.agg(F.count("*"), same).first():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).union(after.select("b", "b").distinct())
        edges = after


def components(prints: DataFrame, max_bits: int = MAX_BITS, id_col: str = "id") -> DataFrame:
    """Rows (fp, root, component_id) for every distinct fingerprint of ``prints`` (fp, id)."""
    distinct = written(prints.groupBy("fp").agg(F.min(id_col).alias("low")), "fingerprints")
    found = connected(candidate_links(distinct, max_bits))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.select("fp", "root").join(lowest, "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: (id, fingerprint as 16 hex digits, component_id)."""
    thin = with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", "fp", shingle_words)
    thin = written(thin.select("id", "fp"), "prints")
    found = components(thin, max_bits)
    return thin.join(found, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Keep one document of each near-duplicate group: the one with the smallest id (null ids last), of
    several rows with that id the one with the smallest fingerprint, then the first in its file. All
    columns of ``docs`` are kept as they are.

    Rows are chosen on a table of (row identity, id, fingerprint); the texts only learn which rows
    go, by a join on the identity (broadcast up to a bound, see ``operators.identity``). Give rows read
    from files their identity; any other frame is written once for it. The result does not carry it."""
    rows = docs if identity.is_identified(docs) else identity.stored(docs)
    thin = with_fingerprint(rows.select(identity.ROW_ID, F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", "fp", shingle_words)
    thin = written(thin.drop("text"), "prints")
    found = components(thin.select("fp", "id"), max_bits)
    grouped = thin.join(found.select("fp", "root"), "fp")
    first = F.struct(F.col("id").isNull().alias("n"), "id", "fp", identity.ROW_ID)
    keep = grouped.groupBy("root").agg(F.min(first).alias("o")).select(f"o.{identity.ROW_ID}")
    gone = written(thin.join(keep, identity.ROW_ID, "left_anti").select(identity.ROW_ID), "copies")
    return identity.flagged(rows, gone, "__dg_gone").filter(F.col("__dg_gone").isNull()).select(*[c for c in docs.columns if c != identity.ROW_ID])


common.ship(__name__)
