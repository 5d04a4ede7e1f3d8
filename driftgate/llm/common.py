"""What the operators share: reading a given table, and word splitting in Spark and in Python, and packing."""

from __future__ import annotations

import importlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(module: str) -> None:
    """Send a module's functions to the Python workers by value, so that executors need no
    copy of this package on their path."""
    cloudpickle.register_pickle_by_value(importlib.import_module(module))


def bucket(key: bytes, n: int) -> int:
    """A hash bucket of a byte string."""
    return xxhash.xxh64_intdigest(key) % n


def words(text: Column) -> Column:
    """The words of a text as an array (null and empty texts: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


#: Words remembered with their hash, so that frequent words are hashed once.
WORD_CACHE = 500_000


class WordHashes(dict):
    """Word -> 64-bit hash, remembering up to ``WORD_CACHE`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * np.uint64(0x9E3779B97F4A7C15)
    out ^= b
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words, from the words' hashes, by runs of 2, 4, 8..."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    runs, size = [hashes], 1
    while 2 * size <= k:
        runs.append(_mixed(runs[-1][:-size], runs[-1][size:]))
        size *= 2
    out, at = runs[-1][:n], size
    for i in reversed(range(len(runs) - 1)):
        if k >> i & 1:
            out = _mixed(out, runs[i][at : at + n])
            at += 1 << i
    return out ^ np.uint64(k)


def pack(parts: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, parts), np.uint32, len(parts))
    return zstandard.ZstdCompressor(3).compress(np.uint32(len(parts)).tobytes() + lengths.tobytes() + b"".join(parts))


def unpack(blob: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw[:4], np.uint32)[0])
    ends = np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64) + 4 + 4 * n
    at = [4 + 4 * n, *ends.tolist()]
    return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]


def squeezed(docs: DataFrame) -> DataFrame:
    """(id, text, block) as (id, blob, block), the text as zstandard-compressed UTF-8: what blocks
    of documents travel as. A null text is an empty one."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeezer = zstandard.ZstdCompressor(3)
        for batch in batches:
            blobs = [squeezer.compress(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary()), batch.column(2)], names=["id", "blob", "block"])

    return docs.select("id", "text", "block").mapInArrow(run, f"id {id_type}, blob binary, block long")


ship(__name__)
