"""Token ids as files of independent zstandard frames with a trailing seek table.

A file is a run of zstandard frames, each holding the uint32 little-endian ids of whole documents
(about ``FRAME_TOKENS`` ids; a longer document has a frame of its own), then a skippable frame with
the directory (ids, nulls and lengths of the documents, documents per frame) and, last, the seek
table of the zstandard seekable format: compressed and decompressed size and the low 32 bits of
the XXH64 of each frame's content, so that a reader decompresses and verifies only the frames of
the documents it wants. Any zstandard decoder reads the ids of the whole file.

Documents are dealt to files by range of id, ties by the text's hash, about ``FILE_CHARS`` of text
each, and a file is written by one task, under a name of its own per attempt; the manifest, a
Parquet table, names the files of the attempts that counted. Files go through pyarrow's file
systems, so the folder may be on any store they and Spark both reach.

Defined results: a null or empty text has the end id only; null ids come first; rows with equal
id stand next to each other, in the order of their text's hash; an empty table writes no file.
Ids must be integers.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftgate.llm import common, tokens
from driftgate.session import written

FRAME_TOKENS = 1 << 18
FILE_CHARS = 32_000_000
END_ID = 2
_SKIPPABLE_DIRECTORY = 0x184D2A50
# Fixed values of the zstandard seekable format.
_SKIPPABLE_SEEK = 0x184D2A5E
_SEEKABLE_MAGIC = 0x8F92EAB1
_CHECKSUMS = 0x80

_MANIFEST = "file long, path string, n_docs long, n_tokens long, n_bytes long"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """A path as Spark writes it (``file:/x`` too), as a file system and a path on it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class FrameWriter:
    """Writes one file."""

    def __init__(self, out, frame_tokens: int = FRAME_TOKENS):
        self.out, self.frame_tokens = out, frame_tokens
        self.entries: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.per_frame: list[int] = []
        self.open: list[bytes] = []
        self.squeezer = zstandard.ZstdCompressor(3, write_content_size=True, write_checksum=True)

    def add(self, doc_id: int | None, packed: bytes) -> None:
        if self.open and sum(map(len, self.open)) + len(packed) > 4 * self.frame_tokens:
            self.flush()
        self.open.append(packed)
        self.ids.append(doc_id)
        self.lengths.append(len(packed) // 4)

    def flush(self) -> None:
        if self.open:
            content = b"".join(self.open)
            frame = self.squeezer.compress(content)
            self.entries.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
            self.per_frame.append(len(self.open))
            self.out.write(frame)
            self.open = []

    def close(self) -> int:
        self.flush()
        body = struct.pack("<II", len(self.ids), len(self.per_frame))
        body += np.array([i or 0 for i in self.ids], "<i8").tobytes() + np.array([i is None for i in self.ids], "u1").tobytes()
        body += np.array(self.lengths, "<u4").tobytes() + np.array(self.per_frame, "<u4").tobytes()
        body = zstandard.ZstdCompressor(3).compress(body)
        self.out.write(struct.pack("<II", _SKIPPABLE_DIRECTORY, len(body) + 4) + body + struct.pack("<I", len(body)))
        table = b"".join(struct.pack("<III", *e) for e in self.entries) + struct.pack("<IBI", len(self.entries), _CHECKSUMS, _SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", _SKIPPABLE_SEEK, len(table)) + table)
        return sum(e[0] for e in self.entries) + len(body) + 12 + len(table) + 8


class FrameReader:
    """Reads one file through its seek table."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != _SEEKABLE_MAGIC or flags != _CHECKSUMS:
            raise ValueError("not a seekable file with checksums")
        start = size - 9 - 12 * count
        raw = self._at(start, 12 * count)
        self.entries = [struct.unpack_from("<III", raw, 12 * i) for i in range(count)]
        (length,) = struct.unpack("<I", self._at(start - 12, 4))
        body = zstandard.ZstdDecompressor().decompress(self._at(start - 12 - length, length))
        n, frames = struct.unpack_from("<II", body)
        ids, nulls = np.frombuffer(body, "<i8", n, 8), np.frombuffer(body, "u1", n, 8 + 8 * n)
        self.ids = [None if z else i for i, z in zip(ids.tolist(), nulls.tolist(), strict=True)]
        self.lengths = np.frombuffer(body, "<u4", n, 8 + 9 * n).astype(np.int64)
        per_frame = np.frombuffer(body, "<u4", frames, 8 + 13 * n).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(per_frame)])
        self.offsets = np.concatenate([[0], np.cumsum([e[0] for e in self.entries])]).astype(np.int64)

    def _at(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def frame(self, i: int) -> bytes:
        packed, size, checksum = self.entries[i]
        content = zstandard.ZstdDecompressor().decompress(self._at(int(self.offsets[i]), packed), max_output_size=size)
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} fails its checksum")
        return content

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int, int | None, bytes]]:
        """(position, id, packed ids) of all documents, or of those with the ids wanted; frames
        without any of them are not read."""
        for i in range(len(self.entries)):
            own = range(int(self.first[i]), int(self.first[i + 1]))
            if wanted is not None and not any(self.ids[d] in wanted for d in own):
                continue
            content, at = self.frame(i), 0
            for d in own:
                size = 4 * int(self.lengths[d])
                if wanted is None or self.ids[d] in wanted:
                    yield d, self.ids[d], content[at : at + size]
                at += size


def write(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, file_chars: int = FILE_CHARS) -> DataFrame:
    """Encode and write all documents; returns the manifest (file, path, n_docs, n_tokens,
    n_bytes, start), files in ascending order of id, start the ids in all files before."""
    thin = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    n_files = (thin.agg(F.sum(F.length("text")).alias("n")).first().n or 0) // file_chars + 1
    dealt = thin.withColumn("th", F.xxhash64("text")).repartitionByRange(n_files, "id", "th").sortWithinPartitions("id", "th").select("id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer_path)
        number = TaskContext.get().partitionId()
        path = f"{folder}/ids-{number:06d}-{uuid.uuid4().hex}.zst"
        writer = out = None
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if writer is None:
                    store, inner = _store(path)
                    store.create_dir(inner.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(inner, compression=None)
                    writer = FrameWriter(out)
                writer.add(doc_id, encode.ids(text or "") + end)
        if writer is not None:
            n_bytes = writer.close()
            out.close()
            row = {"file": [number], "path": [path], "n_docs": [len(writer.ids)], "n_tokens": [sum(writer.lengths)], "n_bytes": [n_bytes]}
            yield pa.RecordBatch.from_pydict(row)

    manifest = written(dealt.mapInArrow(run, _MANIFEST), "id_files")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read(spark: SparkSession, manifest: DataFrame, wanted: set[int] | None = None) -> DataFrame:
    """The documents of the files of a manifest: (doc_id, start, n_tokens, ids binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, inner = _store(path)
                with store.open_input_file(inner) as source:
                    reader = FrameReader(source)
                    starts = start + np.concatenate([[0], np.cumsum(reader.lengths)])
                    rows: list[tuple] = []
                    size = 0
                    for d, doc_id, packed in reader.documents(wanted):
                        rows.append((doc_id, int(starts[d]), len(packed) // 4, packed))
                        size += len(packed)
                        if size > 16_000_000:
                            yield _batch(rows)
                            rows, size = [], 0
                    yield _batch(rows)

    files = manifest.select("path", "start").repartition(max(1, manifest.count()), "path")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "start", "n_tokens", "ids"])


def checksums(documents: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents read."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


common.ship(__name__)
