"""SentencePiece encoding and decoding as a relational lattice.

Text is cut into chunks, a run of spaces and the word after it, and chunks into units between
neighbouring characters that no piece of the model holds side by side. No piece crosses a cut
(checked), so units are encoded on their own and each distinct unit once. A unit's substrings, of at most the longest piece's length, are exploded and equi-joined to the piece
table (a vocabulary, so of proven size: broadcast); the matches are the edges of its lattice,
grouped by unit, and folded with Spark's ``aggregate``:

- a unigram model is folded by Viterbi: best score up to each position, over the edges by end;
- a BPE model scores merges, not paths, and the best path by summed scores differs from what the
  model encodes (on sf0.01 for 60 % of the distinct words). Its fold applies to the same lattice the edge with the best
  score that joins two neighbouring symbols, leftmost first, until none is left: the edges sorted
  by score are folded over a bit mask of the symbols' ends. That equals the SentencePiece
  library's ids.

To bring the ids back without moving every word of the corpus, documents are cut where they are
read: a partition's rows make blocks of about ``BLOCK_CHARS`` of text. A block asks each hash bucket
of the vocabulary for its distinct units, once each, and sends its documents along as numbers of
its units, so no text is moved or cut again; packed ids come back in the order asked and are gathered by number.
Questions and numbered documents share one exchange, so both come of one cut; each answer names the
question's hash, and one that fits another question (rows in another order after a lost task) raises.
Group sizes: a block has its size and a bucket the units of a fraction of a block, whatever the corpus. A unit
of over ``LONG_CHUNK`` characters is encoded where its document is, by the same merges on a heap.

Defined results: null and empty texts have no ids; characters outside the vocabulary are spelt
in byte pieces, or the unknown piece if the model has none; repeated rows get equal results, one
each; an empty table gives an empty result. Decoding gives the text back exactly unless it used
the unknown piece. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from driftgate.llm import common

BLOCK_CHARS = 6_000_000
ROW_CHARS = 16  # what a row counts beside its text, so that empty texts end a block too
#: Buckets of the vocabulary per block of documents, so that a bucket's edges sort in memory.
BUCKETS_A_BLOCK = 4
LONG_CHUNK = 60  # positions must fit the bits of a long
SPACE = "▁"
NEAR = 0x250  # pairs of characters below are looked up in a table, others searched
RUNS_AT_ONCE = 1 << 16
_AFTER_SPACE = re.compile(" ( *[^ ]*)")


@dataclass(frozen=True)
class Model:
    """What encoding needs of a SentencePiece model file."""

    unigram: bool
    pieces: tuple[str, ...]  # by id
    scores: dict[str, tuple[int, float]]  # of the pieces that text can match
    byte_ids: tuple[int, ...]  # of the 256 bytes; empty without byte fallback
    unknown: int
    prefix: bool

    @property
    def longest(self) -> int:
        return max(map(len, self.scores))

    @cached_property
    def joints(self) -> np.ndarray:
        """The pairs of neighbouring characters that some piece holds, as sorted numbers."""
        pairs = {p[i : i + 2] for p in self.scores for i in range(len(p) - 1)}
        return np.array(sorted(ord(a) << 21 | ord(b) for a, b in pairs) or [-1], np.int64)

    @cached_property
    def near_joints(self) -> np.ndarray:
        """Whether a piece holds the pair, by first * NEAR + second character, both below NEAR."""
        first, second = self.joints >> 21, self.joints & 0x1FFFFF
        near = (first >= 0) & (first < NEAR) & (second < NEAR)
        table = np.zeros(NEAR * NEAR, bool)
        table[first[near] * NEAR + second[near]] = True
        return table

    def joined(self, codes: np.ndarray) -> np.ndarray:
        """Whether some piece holds each character and the one after it."""
        a, b = codes[:-1], codes[1:]
        near = (a < NEAR) & (b < NEAR)
        out = self.near_joints[np.where(near, a * NEAR + b, 0)]
        far = np.flatnonzero(~near)
        pairs = a[far] << 21 | b[far]
        out[far] = self.joints[np.minimum(np.searchsorted(self.joints, pairs), len(self.joints) - 1)] == pairs
        return out


def load(path: str) -> Model:
    """Read a model file of type unigram or BPE with the identity normalizer."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    spec, kind = proto.normalizer_spec, proto.trainer_spec.model_type
    if kind not in (1, 2) or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only unigram and BPE models without normalization are supported")
    scores = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type in (1, 4)}
    if max(map(len, scores)) > LONG_CHUNK or len(proto.pieces) > 1 << 19:
        raise ValueError("a piece or the vocabulary is too long for packed edges")
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in scores):
        raise ValueError("a piece crosses the start of a word")
    by_byte = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 6}
    unknown = next(i for i, p in enumerate(proto.pieces) if p.type == 2)
    byte_ids = tuple(by_byte[f"<0x{b:02X}>"] for b in range(256)) if by_byte else ()
    return Model(kind == 1, tuple(p.piece for p in proto.pieces), scores, byte_ids, unknown, spec.add_dummy_prefix)


def keys(text: str, prefix: bool = True) -> list[str]:
    """A short form of the text's chunks: what follows a chunk's first space (a start of text
    without one is marked by U+2581). Without runs of spaces that is a plain split."""
    if not text:
        return []
    text = text.replace(SPACE, " ")
    head = []
    if not prefix:
        first, space, text = text.partition(" ")
        head = [SPACE + first] if first else []
        if not space:
            return head
    words = text.split(" ")
    return head + (_AFTER_SPACE.findall(" " + text) if "" in words else words)


def chunk_of(key: str) -> str:
    return key[1:] if key[:1] == SPACE else SPACE + key.replace(" ", SPACE)


def chunks(text: str, prefix: bool = True) -> list[str]:
    return [chunk_of(k) for k in keys(text, prefix)]


def units(model: Model, parts: list[str]) -> tuple[list[str], list[int]]:
    """Chunks cut where no piece holds both neighbours, so that no edge of a lattice is cut: all
    units in order, and how many there are up to the end of each chunk."""
    whole = "".join(parts)
    codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    cut = np.ones(len(codes) + 1, bool)
    cut[1:-1] = ~model.joined(codes)
    cut[ends] = True
    at = np.flatnonzero(cut)
    places = at.tolist()
    return [whole[a:b] for a, b in zip(places, places[1:], strict=False)], np.searchsorted(at, ends).tolist()


def spell(model: Model, symbols: list[str]) -> list[int]:
    out = []
    for s in symbols:
        if s in model.scores:
            out.append(model.scores[s][0])
        else:
            out += [model.byte_ids[b] for b in s.encode()] if model.byte_ids else [model.unknown]
    return out


def encode_long(model: Model, chunk: str) -> list[int]:
    """A chunk of any length: Viterbi for unigram, else best merge first on a heap."""
    n, scores = len(chunk), model.scores
    if model.unigram:
        worst = min(s for _, s in scores.values()) - 10.0
        best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
        for i in range(n):
            for j in range(i + 1, min(n, i + model.longest) + 1):
                known = scores.get(chunk[i:j])
                score = known[1] if known else worst if j == i + 1 else None
                if score is not None and best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, i
        cuts = [n]
        while cuts[-1]:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
        return spell(model, [chunk[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
    symbols, after, before = list(chunk), list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[float, int, int, str]] = []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < n and (known := scores.get(joined := symbols[i] + symbols[after[i]])):
            heapq.heappush(heap, (-known[1], i, after[i], joined))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, j, joined = heapq.heappop(heap)
        if not symbols[i] or after[i] != j or not symbols[j] or symbols[i] + symbols[j] != joined:
            continue
        symbols[i], symbols[j], after[i] = joined, "", after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return spell(model, [s for s in symbols if s])


def late_pieces(model: Model) -> set[str]:
    """Pieces that two neighbours can form of which one was merged at a score no better than theirs."""

    def no_better(part: str, score: float) -> bool:
        return len(part) > 1 and model.scores[part][1] <= score

    def splits(piece: str) -> Iterator[tuple[str, str]]:
        return ((piece[:k], piece[k:]) for k in range(1, len(piece)))

    return {
        p for p, (_, score) in model.scores.items()
        if any(
            all(len(x) == 1 or x in model.scores for x in pair) and any(no_better(x, score) for x in pair)
            for pair in splits(p)
        )
    }


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """(piece, id, score, code): ``code`` orders pieces by falling score (high 32 bits) and holds
    the length from bit 20, whether the piece is late (bit 19), and the id."""
    order = {s: i for i, s in enumerate(sorted({s for _, s in model.scores.values()}, reverse=True))}
    late = late_pieces(model)
    rows = [(p, i, float(s), order[s] << 32 | len(p) << 20 | (p in late) << 19 | i) for p, (i, s) in model.scores.items()]
    return spark.createDataFrame(rows, "piece string, id int, score double, code long")


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``value`` computed once under ``name``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _viterbi(model: Model) -> str:
    """SQL: the best path over ``edges`` as an array of (start, id or null)."""
    # State: for each position the best score up to it, where its last edge starts, and its piece.
    worst = min(s for _, s in model.scores.values()) - 10.0
    reach = (
        "transform(filter(edges, e -> e.stop = j), e -> "
        "struct(get(best, e.start).score + e.score as score, -e.start as back, e.id as id))"
    )
    unknown = (
        "if(exists(edges, e -> e.stop = j and e.start = j - 1), array(), "
        f"array(struct(get(best, j - 1).score + {worst}D as score, 1 - j as back, cast(null as int) as id)))"
    )
    root = "array(named_struct('score', 0D, 'back', 0, 'id', cast(null as int)))"
    forward = f"aggregate(sequence(1, n), {root}, (best, j) -> concat(best, array(array_max(concat({reach}, {unknown})))))"
    trace = (
        "aggregate(sequence(1, n), named_struct('at', n, 'out', slice(array(named_struct('start', 0, 'id', cast(null as int))), 1, 0)), "
        "(s, k) -> if(s.at = 0, s, named_struct('at', -get(best, s.at).back, 'out', "
        "concat(array(named_struct('start', -get(best, s.at).back, 'id', get(best, s.at).id)), s.out))), s -> s.out)"
    )
    return _let("best", forward, trace)


def _merges() -> str:
    """SQL: best merge first over ``codes`` and ``singles``, as an array of (start, id or null).

    The state is a bit mask of the positions where a symbol starts or ends. An edge joins two
    symbols if its own ends are set and one position between them. One pass over the edges by
    score is enough unless a merge makes an edge possible that the pass has left behind, which only
    late pieces allow; bit 62 notes that, and the word is then folded with a fresh search a step.
    """
    start, length = "cast(shiftright(c, 26) & 63 as int)", "cast(shiftright(c, 20) & 63 as int)"
    span = (
        f"named_struct('code', c, 'span', shiftleft(shiftleft(1L, {length} + 1) - 1, {start}), "
        f"'ends', shiftleft(1L + shiftleft(1L, {length}), {start}))"
    )
    joins = "bit_count({m} & {e}.span) = 3 and ({m} & {e}.ends) = {e}.ends".format
    joined = "(({m} & ~{e}.span) | {e}.ends)".format
    late = f"exists(late, f -> f.code < e.code and {joins(m='m', e='f')})"
    one_pass = (
        f"aggregate(spans, whole, (s, e) -> if({joins(m='s', e='e')}, "
        f"{_let('m', joined(m='s', e='e'), f'if({late}, m | {1 << 62}L, m)')}, s))"
    )
    searched = (
        "aggregate(sequence(1, n), whole, (s, k) -> coalesce(get(transform(slice("
        f"filter(spans, e -> {joins(m='s', e='e')}), 1, 1), e -> {joined(m='s', e='e')}), 0), s))"
    )
    cut = _let("late", "filter(spans, e -> (e.code & 524288) != 0)", one_pass)
    mask = _let("whole", "shiftleft(1L, n + 1) - 1", _let("quick", cut, f"if((quick & {1 << 62}L) = 0, quick, {searched})"))
    symbols = (
        "array_sort(concat("
        "transform(filter(spans, e -> (mask & e.span) = e.ends), e -> "
        "named_struct('start', cast(shiftright(e.code, 26) & 63 as int), 'id', cast(e.code & 524287 as int))), "
        "filter(singles, e -> (shiftright(mask, e.start) & 3) = 3)))"
    )
    return _let("spans", f"transform(sort_array(codes), c -> {span})", _let("mask", mask, symbols))


def lattice_ids(words: DataFrame, model: Model) -> DataFrame:
    """``words`` (bucket, word of up to ``LONG_CHUNK`` characters; distinct, dealt by bucket) with
    the column ``ids``."""
    n = F.char_length("word")
    cut = words.select("bucket", "word", F.explode(F.sequence(F.lit(0), n - 1)).alias("start"))
    cut = cut.select("bucket", "word", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(model.longest), n - F.col("start")))).alias("length"))
    cut = cut.withColumn("piece", F.substring("word", F.col("start") + 1, F.col("length")))
    found = cut.join(F.broadcast(piece_table(words.sparkSession, model)), "piece", "left").where("id is not null or length = 1")
    if model.unigram:
        edge = F.struct("start", (F.col("start") + F.col("length")).alias("stop"), "id", "score")
        lists = [F.collect_list(F.when(F.col("id").isNotNull(), edge)).alias("edges")]
        symbols = _viterbi(model)
    else:
        code = F.col("code") + F.shiftleft(F.col("start").cast("long"), 26)
        lists = [
            F.collect_list(F.when(F.col("length") > 1, code)).alias("codes"),
            F.collect_list(F.when(F.col("length") == 1, F.struct("start", "id"))).alias("singles"),
        ]
        symbols = _merges()
    lattice = found.groupBy("bucket", "word").agg(*lists)
    if model.byte_ids:
        octets = "hex(substring(word, x.start + 1, 1))"
        other = f"transform(sequence(1, length({octets}), 2), k -> get(__dg_bytes, cast(conv(substring({octets}, k, 2), 16, 10) as int)))"
    else:
        other = f"array({model.unknown})"
    known = "transform(symbols, x -> x.id)"
    spelt = f"if(exists(symbols, x -> x.id is null), flatten(transform(symbols, x -> if(x.id is null, {other}, array(x.id)))), {known})"
    lattice = lattice.withColumn("__dg_bytes", F.lit(list(model.byte_ids)).cast("array<int>"))
    return lattice.select("bucket", "word", F.expr(_let("n", "char_length(word)", _let("symbols", symbols, spelt))).alias("ids"))


def spelling(model: Model) -> list[bytes]:
    """The text of each id."""
    spelt = {i: p.replace(SPACE, " ").encode() for p, (i, _) in model.scores.items()} | {i: bytes([b]) for b, i in enumerate(model.byte_ids)}
    return [spelt.get(i, b"" if i != model.unknown else " ⁇ ".encode()) for i in range(len(model.pieces))]


class Runs:
    """Byte strings in one array, to be joined by their numbers; ``width`` bytes an entry."""

    def __init__(self, parts: list[bytes], width: int = 1):
        self.values = np.frombuffer(b"".join(parts), f"<u{width}")
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))) // width
        self.edges = np.concatenate([[0], ends])

    def gathered(self, numbers: np.ndarray, ends: np.ndarray) -> Runs:
        """The runs of the numbers up to each end, joined to one."""
        out = Runs([])
        out.values = np.frombuffer(self.joined(numbers), self.values.dtype)
        edges = np.concatenate([[0], np.cumsum(np.diff(self.edges)[numbers])])
        out.edges = np.concatenate([[0], edges[ends]])
        return out

    def joined(self, numbers: np.ndarray) -> bytes:
        return b"".join(self._some(numbers[i : i + RUNS_AT_ONCE]) for i in range(0, len(numbers), RUNS_AT_ONCE))

    def _some(self, numbers: np.ndarray) -> bytes:
        starts = self.edges[numbers]
        lengths = self.edges[numbers + 1] - starts
        ends = np.cumsum(lengths)
        at = np.repeat(starts - ends + lengths, lengths)
        at += np.arange(len(at))
        return self.values[at].tobytes()


def decoded(table: Runs, ids: np.ndarray, prefix: bool) -> bytes:
    """The UTF-8 text of a list of ids (bytes that are none become U+FFFD)."""
    raw = table.joined(ids)
    raw = raw[1:] if prefix and raw[:1] == b" " else raw
    try:
        raw.decode()
    except UnicodeDecodeError:
        raw = raw.decode("utf-8", "replace").encode()
    return raw


#: What ``encode`` can return beside the id: column -> type.
RESULTS = {"ids": "array<int>", "n_ids": "long", "ids_crc32": "long", "decoded": "string", "decoded_sha256": "string", "round_trip": "boolean"}


def encode(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS, results: tuple[str, ...] = ("ids",)
) -> DataFrame:
    """One row per document: the id and the named columns of ``RESULTS``: the ids, their number, the crc32
    of them as little-endian uint32, and, decoded from the ids again, the text, its SHA-256, and
    whether it is the text given, by SHA-256 (a null text counts as empty)."""
    if set(results) - set(RESULTS):
        raise ValueError(f"unknown results {sorted(set(results) - set(RESULTS))}")
    table, prefix = Runs(spelling(model)), model.prefix
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    total = thin.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    n_buckets = BUCKETS_A_BLOCK * (total // block_chars + 1)
    id_type, hash_of = thin.schema["id"].dataType.simpleString(), xxhash.xxh64_intdigest
    checking = "round_trip" in results

    def cut(texts: list[str]) -> tuple[list[tuple[int, bytes]], bytes]:
        """The distinct units for each bucket, and the texts as numbers of all distinct units."""
        number: dict[str, int] = defaultdict(count().__next__)  # of each distinct key, in order of first sight
        each = [np.fromiter(map(number.__getitem__, own), np.int32, len(own)) for own in (keys(t, prefix) for t in texts)]
        flat, ends = units(model, list(map(chunk_of, number)))
        del number
        distinct = set(flat)
        long = [u for u in distinct if len(u) > LONG_CHUNK]
        short = sorted(distinct.difference(long))
        words = [u.encode() for u in short]
        to = np.fromiter(map(hash_of, words), np.uint64, len(words)) % np.uint64(n_buckets)
        order = np.argsort(to, kind="stable")
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        position = dict(zip(short, place.tolist(), strict=True)) | {u: len(short) + i for i, u in enumerate(long)}
        buckets, starts = np.unique(to[order], return_index=True)
        places, edges = order.tolist(), [*starts.tolist(), len(order)]
        asked = [(b, common.pack([words[k] for k in places[i:j]])) for b, i, j in zip(buckets.tolist(), edges[:-1], edges[1:], strict=True)]
        parts = [
            np.fromiter(map(len, each), np.int64, len(each)).tobytes(), _planes(np.concatenate(each)), np.array(ends, np.int64).tobytes(),
            _planes(np.fromiter(map(position.__getitem__, flat), np.int32, len(flat))),
            np.array([b for b, _ in asked], np.int64).tobytes(), np.array([hash_of(w) for _, w in asked], np.uint64).tobytes(),
            b"".join(hashlib.sha256(t.encode()).digest() for t in texts) if checking else b"",
        ]
        return asked, common.pack(parts + [np.array(encode_long(model, u), np.int32).tobytes() for u in long])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Questions under their bucket's number, a block of documents under -1 less the block's."""
        block = TaskContext.get().partitionId() << 32

        def messages(ids: list[pa.Array], texts: list[str]) -> pa.RecordBatch:
            asked, numbered = cut(texts)
            ids = pa.concat_arrays(ids)
            n = len(asked) + 1
            return pa.RecordBatch.from_arrays([
                pa.array([-1 - block] + [b for b, _ in asked], pa.int64()), pa.array([block] * n, pa.int64()),
                pa.array([numbered] + [w for _, w in asked], pa.binary()),
                pa.concat_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.nulls(n - 1, pa.list_(ids.type))]),
            ], names=["target", "block", "message", "ids"])

        ids, texts, size = [], [], 0
        for batch in batches:
            start = 0
            for i, text in enumerate(batch.column(1), 1):  # only a block's texts become strings at a time
                texts.append(text.as_py() or "")
                size += len(texts[-1]) + ROW_CHARS
                if size >= block_chars:
                    yield messages([*ids, batch.column(0).slice(start, i - start)], texts)
                    ids, texts, size, start, block = [], [], 0, i, block + 1
            if start < batch.num_rows:
                ids.append(batch.column(0).slice(start))
        if texts:
            yield messages(ids, texts)

    asked = thin.mapInArrow(ask, f"target long, block long, message binary, ids array<{id_type}>").repartition(n_buckets, "target")

    def questions(rows: pa.Table) -> list[bytes]:
        return rows.column("message").to_pylist() if rows.column("target")[0].as_py() >= 0 else []

    def distinct(rows: pa.Table) -> pa.Table:
        words = sorted({w for blob in questions(rows) for w in common.unpack(blob)})
        return pa.table({"bucket": pa.array([rows.column("target")[0].as_py()] * len(words), pa.int64()), "word": pa.array(words, pa.binary()).cast(pa.string())})

    words = asked.groupBy("target").applyInArrow(distinct, "bucket long, word string").repartition(n_buckets, "bucket")
    known = lattice_ids(words, model)

    def answer(rows: pa.Table, entries: pa.Table) -> pa.Table:
        blobs = questions(rows)
        column = entries.column("ids").combine_chunks()
        values, ends = column.values.to_numpy(zero_copy_only=False).astype(np.int32), column.offsets.to_numpy()
        names = entries.column("word").combine_chunks().cast(pa.binary()).to_pylist()
        table = {w: values[a:b].tobytes() for w, a, b in zip(names, ends[:-1].tolist(), ends[1:].tolist(), strict=True)}
        return pa.table({
            "target": pa.array([-1 - block for block in rows.column("block").to_pylist()[: len(blobs)]], pa.int64()),
            "bucket": rows.column("target").slice(0, len(blobs)).cast(pa.int64()),
            "question": pa.array([hash_of(blob).to_bytes(8, "little") for blob in blobs], pa.binary()),
            "ids": pa.array([common.pack([table[w] for w in common.unpack(blob)]) for blob in blobs], pa.binary()),
        })

    replies = asked.groupBy("target").cogroup(known.groupBy("bucket")).applyInArrow(answer, "target long, bucket long, question binary, ids binary")

    def assemble(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in results}
        ids = rows.column("ids").combine_chunks().flatten()
        if rows.column("target")[0].as_py() < 0:
            sizes, own, ends, flat, buckets, hashes, digests, *long = common.unpack(rows.column("message")[0].as_py())
            known = {(a["bucket"], a["question"]): a["ids"] for a in answers.to_pylist()}
            parts: list[bytes] = []
            for i, b in enumerate(np.frombuffer(buckets, np.int64).tolist()):
                if (b, hashes[8 * i : 8 * i + 8]) not in known:
                    raise RuntimeError("the documents came in another order when they were read again")
                parts += common.unpack(known[b, hashes[8 * i : 8 * i + 8]])
            spelt = Runs(parts + long, 4).gathered(_numbers(flat), np.frombuffer(ends, np.int64))
            del known, parts
            decoding = {"decoded", "decoded_sha256", "round_trip"} & set(results)
            at = np.cumsum(np.frombuffer(sizes, np.int64))[:-1]
            for i, numbers in enumerate(np.split(_numbers(own), at)):
                raw = spelt.joined(numbers)
                back = decoded(table, np.frombuffer(raw, "<i4"), prefix) if decoding else b""
                for name, column in out.items():
                    column.append(_result(name, raw, back, digests[32 * i : 32 * i + 32]))
        return pa.table({"id": ids} | {name: _column(name, column) for name, column in out.items()})

    schema = ", ".join([f"id {id_type}", *[f"{name} {RESULTS[name]}" for name in results]])
    out = asked.groupBy("target").cogroup(replies.repartition(n_buckets, "target").groupBy("target")).applyInArrow(assemble, schema)
    return out.withColumnRenamed("id", id_col)


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers with their lowest bytes first, then the next, which compresses better."""
    return np.ascontiguousarray(numbers, "<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _result(name: str, raw: bytes, back: bytes, digest: bytes):
    if name == "n_ids":
        return len(raw) // 4
    if name == "ids_crc32":
        return zlib.crc32(raw)
    if name == "decoded_sha256":
        return hashlib.sha256(back).hexdigest()
    if name == "round_trip":
        return hashlib.sha256(back).digest() == digest
    return raw if name == "ids" else back


def _column(name: str, values: list) -> pa.Array:
    if name == "ids":
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in values])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(values), "<i4")))
    if name == "decoded":
        return pa.array(values, pa.binary()).cast(pa.string())
    return pa.array(values, {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[RESULTS[name]])


def decode(encoded: DataFrame, model: Model, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` plus the decoded text (a null list: null)."""
    table, at = Runs(spelling(model)), encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            texts = [decoded(table, x.values.to_numpy(), model.prefix) if x.is_valid else None for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*batch.schema.names, out])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(out, StringType())]))


common.ship(__name__)
