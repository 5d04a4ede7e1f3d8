"""Substring dedup with repeated-phrase automata.

A window is ``WINDOW`` consecutive words; a word is removed if a window that covers it also starts
in a document with a smaller id. Documents are dealt to blocks by hash and travel compressed, and
everything a task holds is bounded by a block's text or by a bucket's share of the windows:

1. confirm: each block sends every hash bucket its distinct windows as truncated hashes (sorted,
   delta-coded) and learns which of them another block has too; for those, and for windows that
   two of its own documents share, it sends the full hash, its smallest id and where it stands; the
   bucket finds the owner, the smallest id of all, and tells the owner's block which blocks need
   the window at that place;
2. passages: the owner's block joins consecutive windows to passages and sends their text;
3. automata: each block compiles the passages it was sent to Aho-Corasick automata, in shards of
   ``SHARD_CHARS``, and streams all its documents through them. The patterns are a passage's
   consecutive ``PHRASE``-word phrases: any window holds one whole. A match is extended to both
   sides word by word, and counts if it spans a window.

A window that a third of all documents share is one entry a block, however many of the block's
documents have it. What is removed was compared word for word; hashes only choose candidates
(two windows with equal 64-bit hashes could hide one of them, never remove a word wrongly).

Defined results: a null or empty text has no words; rows with a null id are neither owners nor
shortened; rows with equal ids are not smaller than each other; repeated rows get equal results,
one each; an empty table gives an empty result. Ids must be integers. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.llm import common

WINDOW = 13
PHRASE = (WINDOW + 1) // 2
BLOCK_CHARS = 8_000_000
SHARD_CHARS = 2_000_000
KEEP_BITS = 40  # of a hash within its bucket, in the first round


def pack_sorted(values: np.ndarray) -> bytes:
    """A sorted uint64 array: deltas by byte plane, compressed."""
    deltas = np.diff(values, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(deltas.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_sorted(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_ids(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(values.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_ids(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(np.int64).ravel()


class Block:
    """The documents of a block as words, in order of id, and the distinct windows of those with
    an id: their hashes in order, the smallest id that has each, where it first stands there, and
    whether several ids have it."""

    def __init__(self, rows: pa.Table):
        opener = zstandard.ZstdDecompressor()
        pairs = zip(rows.column("id").to_pylist(), rows.column("blob").to_pylist(), strict=True)
        # Texts order rows of one id, so that places mean the same whenever the block is read.
        pairs = sorted(pairs, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        self.numbers = np.array([i or 0 for i, _ in pairs], np.int64)
        self.nulls = np.array([i is None for i, _ in pairs], bool)
        self.words = [opener.decompress(b).split() for _, b in pairs]
        self.first = np.concatenate([[0], np.cumsum([len(w) for w in self.words])]).astype(np.int64)

    def index(self, hashes: common.WordHashes) -> None:
        """Documents stand in order of id, so a window's first place is in its smallest id."""
        every = common.shingle_hashes(hashes.of([w for words in self.words for w in words]), WINDOW)
        doc = np.repeat(np.arange(len(self.words)), np.diff(self.first))[: len(every)]
        place = np.flatnonzero((np.arange(len(every)) + WINDOW <= self.first[1:][doc]) & ~self.nulls[doc])
        order = place[np.argsort(every[place])]
        every = every[order]
        starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
        self.hashes = every[starts]
        self.places = np.minimum.reduceat(order, starts) if len(starts) else starts
        last = np.maximum.reduceat(order, starts) if len(starts) else starts
        self.owners = self.numbers[doc[self.places]]
        self.several = self.numbers[doc[last]] != self.owners

    def by_bucket(self, n: int) -> Iterator[tuple[int, slice, np.ndarray]]:
        """(bucket, its part of ``hashes``, truncated hashes): buckets are ranges of hashes."""
        bucket = ((self.hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        short = self.hashes >> np.uint64(max(0, 64 - KEEP_BITS - n.bit_length()))
        cuts = np.searchsorted(bucket, np.arange(n + 1).astype(np.uint64))
        for b in range(n):
            if cuts[b] < cuts[b + 1]:
                own = slice(int(cuts[b]), int(cuts[b + 1]))
                yield b, own, short[own]


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds, strict=True)})


class Automata:
    """Sharded automata over the phrases of passages (owner, words)."""

    def __init__(self, passages: list[tuple[int, list[str]]]):
        self.passages, self.shards = passages, []
        phrases: dict[str, list[tuple[int, int]]] = {}
        size = 0
        for p, (_, words) in enumerate(passages):
            for at in range(0, len(words) - PHRASE + 1, PHRASE):
                phrase = f" {' '.join(words[at : at + PHRASE])} "
                size += 0 if phrase in phrases else len(phrase)
                phrases.setdefault(phrase, []).append((p, at))
                if size > SHARD_CHARS:
                    self._close(phrases)
                    phrases, size = {}, 0
        self._close(phrases)

    def _close(self, phrases: dict[str, list[tuple[int, int]]]) -> None:
        if phrases:
            shard = ahocorasick.Automaton()
            for phrase, places in phrases.items():
                shard.add_word(phrase, (len(phrase), places))
            shard.make_automaton()
            self.shards.append(shard)

    def removed(self, doc_id: int, words: list[str], text: str) -> np.ndarray:
        """Which words of ``text``, the words with one space before and after each, are covered by
        a window of a passage with a smaller owner."""
        gone = np.zeros(len(words), bool)
        begins: list[int] = []  # of the space before each word, found at the first match
        reach: dict[tuple[int, int], int] = {}  # passage and shift: how far it was extended
        for shard in self.shards:
            for end, (size, places) in shard.iter(text):
                if not begins:
                    begins = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32).tolist()
                at = bisect_left(begins, end + 1 - size)
                for p, offset in places:
                    owner, own = self.passages[p]
                    shift = at - offset
                    if owner >= doc_id or reach.get((p, shift), -1) > at:
                        continue
                    a, b = at, at + PHRASE
                    while a > 0 and a > shift and words[a - 1] == own[a - 1 - shift]:
                        a -= 1
                    while b < len(words) and b - shift < len(own) and words[b] == own[b - shift]:
                        b += 1
                    reach[p, shift] = b
                    if b - a >= WINDOW:
                        gone[a:b] = True
        return gone


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: (id, n_words, n_removed, kept)."""
    thin = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    n = (thin.agg(F.sum(F.length("text")).alias("n")).first().n or 0) // block_chars + 1
    blocks = common.squeezed(thin.select("id", "text", F.pmod(F.xxhash64("id", "text"), F.lit(n)).alias("block")))

    def block_of(rows: pa.Table) -> int:
        return rows.column("block")[0].as_py()

    def ask(rows: pa.Table) -> pa.Table:
        own = Block(rows)
        own.index(common.WordHashes())
        out = [(block_of(rows), b, pack_sorted(short)) for b, _, short in own.by_bucket(n)]
        return _table(out, ["block", "bucket", "short"], [pa.int64(), pa.int64(), pa.binary()])

    asked = blocks.groupBy("block").applyInArrow(ask, "block long, bucket long, short binary")

    def elsewhere(rows: pa.Table) -> pa.Table:
        lists = [unpack_sorted(x) for x in rows.column("short").to_pylist()]
        # A block may hold two windows of one truncated hash: count blocks, not entries.
        every = np.sort(np.concatenate([x[np.concatenate([[True], x[1:] != x[:-1]])] for x in lists]))
        shared = every[1:][every[1:] == every[:-1]]
        shared = np.append(shared[np.concatenate([[True], shared[1:] != shared[:-1]])] if len(shared) else shared, np.uint64(2**64 - 1))
        masks = []
        for x in lists:
            hit = shared[np.minimum(np.searchsorted(shared, x), len(shared) - 1)] == x
            masks.append(zstandard.ZstdCompressor(1).compress(np.packbits(hit).tobytes()))
        return pa.table({"block": rows.column("block"), "bucket": rows.column("bucket"), "mask": pa.array(masks, pa.binary())})

    masks = asked.groupBy("bucket").applyInArrow(elsewhere, "block long, bucket long, mask binary")

    claimed = ["block", "bucket", "hashes", "owners", "places", "several"]
    claimed_types = [pa.int64(), pa.int64(), *[pa.binary()] * 4]

    def claim(rows: pa.Table, replies: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _table([], claimed, claimed_types)
        own = Block(rows)
        own.index(common.WordHashes())
        mask = dict(zip(replies.column("bucket").to_pylist(), replies.column("mask").to_pylist(), strict=True))
        out = []
        for b, part, _ in own.by_bucket(n):
            bits = np.frombuffer(zstandard.ZstdDecompressor().decompress(mask[b]), np.uint8)
            at = part.start + np.flatnonzero(np.unpackbits(bits, count=part.stop - part.start).astype(bool) | own.several[part])
            if len(at):
                out.append((block_of(rows), b, pack_sorted(own.hashes[at]), pack_ids(own.owners[at]), pack_ids(own.places[at]), np.packbits(own.several[at]).tobytes()))
        return _table(out, claimed, claimed_types)

    claims = blocks.groupBy("block").cogroup(masks.groupBy("block")).applyInArrow(claim, "block long, bucket long, hashes binary, owners binary, places binary, several binary")

    def assign(rows: pa.Table) -> pa.Table:
        columns = [rows.column(c).to_pylist() for c in claimed if c != "bucket"]
        parts = [[], [], [], [], []]
        for block, hashes, owners, places, several in zip(*columns, strict=True):
            own = unpack_sorted(hashes)
            flags = np.unpackbits(np.frombuffer(several, np.uint8), count=len(own)).astype(bool)
            for part, x in zip(parts, (own, unpack_ids(owners), np.full(len(own), block, np.int64), unpack_ids(places), flags), strict=True):
                part.append(x)
        every, owner, block, place, several = (np.concatenate(p) for p in parts)
        order = np.lexsort((block, owner, every))
        every, block, place, several = every[order], block[order], place[order], several[order]
        head = np.concatenate([[True], every[1:] != every[:-1]])
        group = np.cumsum(head) - 1
        home = block[head][group]
        # The owner's own block needs the window only if a second document there has it.
        needs = ~head | several
        alone = np.bincount(group)[group] == 1
        needs &= ~alone | several
        home, target, place = home[needs], block[needs], place[head][group][needs]
        order = np.lexsort((place, target, home))
        home, target, place = home[order], target[order], place[order]
        cuts = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1]])) if len(home) else np.zeros(0, np.int64)
        # One row for each home block, with (target, place) pairs: not one for each pair of blocks.
        out = [(int(home[a]), pack_ids(target[a:b]), pack_ids(place[a:b])) for a, b in zip(cuts, np.append(cuts[1:], len(home)), strict=False)]
        return _table(out, ["block", "targets", "places"], [pa.int64(), pa.binary(), pa.binary()])

    needed = claims.groupBy("bucket").applyInArrow(assign, "block long, targets binary, places binary")

    def passages(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and wanted.num_rows:
            own = Block(rows)
            targets: dict[int, list[np.ndarray]] = {}
            for packed, places in zip(wanted.column("targets").to_pylist(), wanted.column("places").to_pylist(), strict=True):
                target, place = unpack_ids(packed), unpack_ids(places)
                cuts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(target)], strict=True):
                    targets.setdefault(int(target[a]), []).append(place[a:b])
            for target, lists in targets.items():
                at = np.sort(np.concatenate(lists))
                cuts = np.flatnonzero(np.diff(at, prepend=-2) != 1)
                found = []
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)], strict=True):
                    doc = int(np.searchsorted(own.first, at[a], side="right")) - 1
                    start = int(at[a] - own.first[doc])
                    words = own.words[doc][start : start + int(at[b - 1] - at[a]) + WINDOW]
                    found.append(int(own.numbers[doc]).to_bytes(8, "little", signed=True) + b" ".join(words))
                out.append((target, common.pack(found)))
        return _table(out, ["block", "passages"], [pa.int64(), pa.binary()])

    sent = blocks.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(passages, "block long, passages binary")

    def stream(rows: pa.Table, received: pa.Table) -> pa.Table:
        found = [x for blob in received.column("passages").to_pylist() for x in common.unpack(blob)]
        automata = Automata([(int.from_bytes(x[:8], "little", signed=True), x[8:].decode().split(" ")) for x in found])
        out = []
        opener = zstandard.ZstdDecompressor()
        for doc_id, blob in zip(rows.column("id").to_pylist(), rows.column("blob").to_pylist(), strict=True):
            text = b" ".join(opener.decompress(blob).split()).decode()
            words = text.split(" ") if text else []
            gone = automata.removed(doc_id, words, f" {text} ") if doc_id is not None and len(words) >= WINDOW else np.zeros(0, bool)
            if gone.any():
                text = " ".join(compress(words, ~gone))
            out.append((doc_id, len(words), int(gone.sum()), text))
        return _table(out, ["id", "n_words", "n_removed", "kept"], [pa.int64(), pa.int64(), pa.int64(), pa.string()])

    out = blocks.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(stream, "id long, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("id", id_col)


common.ship(__name__)
