"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark item is cut into windows of ``window_words`` consecutive words (a shorter item
is one window) and every window into shingles of up to three words. A document contains a window
only if it contains all of the window's shingles, so for exact containment one shingle is a
sufficient prefix: the rarest one, by its count over all documents. Documents are joined on the
prefix shingles, a candidate's offset gives the only place where the window can start (position
bound) and its length must fit the document (length bound), and what is left is compared word
for word over the window.

Documents are streamed once. A bitmap of the benchmark's shingles, of fixed size whatever the
size of the benchmark (``BITMAP_BITS``: 2 MiB), decides which positions are written down; a
position let through by chance meets no shingle in the join.

Defined results: null and empty texts have no words, no windows and no hits; an item without words
has no window; repeated rows get one result each; items that share a window all count; an item
whose id is null marks words but has no name to list; an empty benchmark hits nothing; an empty
document table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.llm import common
from driftgate.session import written

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
BITMAP_BITS = 24

_LOWER_OR_GAP = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def tokenize(text: bytes) -> list[bytes]:
    """Words: runs of digits, letters (A-Z as a-z) and anything outside ASCII."""
    return text.translate(_LOWER_OR_GAP).split()


WINDOW_SCHEMA = "item_id string, window string, n int, offset int, k int, h long"
HIT_SCHEMA = "id {id}, th long, n_words long, pos long, h long, lead int, context string"


def item_shingles(benchmark: DataFrame, id_col: str, text_col: str, window_words: int) -> DataFrame:
    """One row per item, window and shingle of the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.WordHashes()
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = tokenize(text or b"")
                if not words:
                    continue
                n = min(window_words, len(words))
                k = min(SHINGLE_WORDS, n)
                hashes = common.shingle_hashes(known.of(words), k).view(np.int64).tolist()
                for start in range(len(words) - n + 1):
                    window = b" ".join(words[start : start + n]).decode()
                    rows += [(item, window, n, i, k, hashes[start + i]) for i in range(n - k + 1)]
            names = ["item_id", "window", "n", "offset", "k", "h"]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    thin = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
    return thin.mapInArrow(run, WINDOW_SCHEMA)


def bitmap_of(shingles: DataFrame) -> bytes:
    """The set of shingle hashes as a bitmap on their first ``BITMAP_BITS`` bits; the rows that
    reach the driver are its 64-bit cells, at most 2 ** (BITMAP_BITS - 6)."""
    slot = F.shiftrightunsigned("h", 64 - BITMAP_BITS)
    cells = shingles.select(
        F.shiftright(slot, 6).alias("cell"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - BITMAP_BITS}) & 63 as int))").alias("bit")
    ).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for row in cells.toLocalIterator():
        out[row.cell] = row.bits
    return out.tobytes()


def document_hits(docs: DataFrame, id_col: str, text_col: str, shingles: DataFrame, window_words: int) -> DataFrame:
    """One row per document (``pos`` null) with its number of words, and one row per position
    whose shingle is in the benchmark's bitmap, with the words around it."""
    sizes = [r.k for r in shingles.select("k").distinct().collect()]  # 3 at most
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(shingles))  # 2 MiB
    thin = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    id_type = thin.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint64)
        known = common.WordHashes()
        for batch in batches:
            at, n_words, pos, hashes, lead, context = [], [], [], [], [], []
            for i, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                words = tokenize(text or b"")
                at.append(i)
                n_words.append(len(words))
                for column in (pos, hashes, lead, context):
                    column.append(None)
                own = known.of(words)
                for k in sizes:
                    found = common.shingle_hashes(own, k)
                    slots = found >> np.uint64(64 - BITMAP_BITS)
                    hit = np.flatnonzero((bits[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1))
                    for p, h in zip(hit.tolist(), found[hit].view(np.int64).tolist(), strict=True):
                        first = max(0, p - window_words + 1)
                        at.append(i)
                        n_words.append(len(words))
                        pos.append(p)
                        hashes.append(h)
                        lead.append(p - first)
                        context.append(b" ".join(words[first : p + window_words]).decode())
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(n_words, pa.int64()), pa.array(pos, pa.int64()),
                 pa.array(hashes, pa.int64()), pa.array(lead, pa.int32()), pa.array(context, pa.string())],
                names=["id", "th", "n_words", "pos", "h", "lead", "context"],
            )

    return thin.mapInArrow(run, HIT_SCHEMA.format(id=id_type))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window_words: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: (id, th, n_words, n_hit, item_ids sorted as strings). ``th`` is the
    text's hash, which with the id names a row."""
    shingles = written(item_shingles(benchmark, item_col, item_text_col, window_words), "bench_shingles")
    hits = written(document_hits(docs, id_col, text_col, shingles, window_words), "bench_hits")
    places = hits.filter(F.col("pos").isNotNull())

    counts = places.groupBy("h").agg(F.count("*").alias("freq"))
    ranked = shingles.select("window", "n", "offset", "h").distinct().join(counts, "h", "left")
    rarest = F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "h", "offset"))
    prefixes = ranked.groupBy("window", "n").agg(rarest.alias("r")).select("window", "n", "r.h", "r.offset")

    start = F.col("pos") - F.col("offset")
    same = F.expr("array_join(slice(split(context, ' '), lead - offset + 1, n), ' ') = window")
    candidates = places.join(prefixes, "h").filter((start >= 0) & (start + F.col("n") <= F.col("n_words")))
    occurs = candidates.filter(same).select("id", "th", start.alias("start"), (start + F.col("n")).alias("end"), "window")
    items = shingles.groupBy("window").agg(F.collect_set("item_id").alias("items"))
    per_doc = occurs.join(items, "window").groupBy("id", "th").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.expr(
        "aggregate(spans, named_struct('n', 0L, 'upto', 0L), (a, s) -> named_struct("
        "'n', a.n + greatest(0L, s.end - greatest(s.start, a.upto)), 'upto', greatest(a.upto, s.end)), a -> a.n)"
    )
    per_doc = per_doc.select(F.col("id").alias("i"), F.col("th").alias("t"), covered.alias("n_hit"), "items")
    whole = hits.filter(F.col("pos").isNull()).select("id", "th", "n_words")
    joined = whole.join(per_doc, F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")), "left")
    return joined.select(
        F.col("id").alias(id_col), "th", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("item_ids"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **named) -> DataFrame:
    """The documents without any occurrence of a benchmark window, all columns as they are."""
    bad = contamination(docs, benchmark, id_col, text_col, **named).filter("n_hit > 0")
    bad = bad.select(F.col(id_col).alias("__dg_id"), F.col("th").alias("__dg_th")).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__dg_id")) & (F.xxhash64(docs[text_col]) == F.col("__dg_th")), "left_anti")


common.ship(__name__)
