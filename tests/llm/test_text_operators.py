"""Operators that read each text on its own, against brute force and the libraries themselves."""

from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import zlib
from collections import Counter
from urllib.parse import quote

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftgate.llm import nested_secrets, piece_lattice, token_attribution, token_frames, tokens
from driftgate.llm.queries import QUERIES, tokenizer
from driftgate.session import scratch_path
from llm_fixtures import docs, no_docs, rows  # noqa: F401

BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer(BPE))


@pytest.fixture(scope="module")
def pieces():
    return piece_lattice.load(tokenizer(PIECES))


SPACES = ["", "\t", "\n", "\r", "\x0b", "\x0c", "\x85", " ", " ", " ", "　", "  ", " \n", "\n ", "\n\n", "\n \n", "\n\n\n", "   ", "   ", "\x1c", " \x1f"]


def test_cached_encoding_equals_whole_encoding(library):
    encode, offsets = tokens.Encoder(tokenizer(BPE)), tokens.Encoder(tokenizer(BPE), offsets=True)
    rnd = random.Random(3)
    parts = ["a", "it's", "Él", "12", "½", "x.", "!?", "漢", "😀", "<|endoftext|>", " ", *SPACES]
    texts = [a + w + b for w in SPACES for a in ("", "a", ".") for b in ("", "b", "1")]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(1500)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False)
        assert np.frombuffer(encode.ids(t), np.int32).tolist() == want.ids, repr(t)
        rows = offsets.rows(t)
        assert rows[:, 0].tolist() == want.ids and [tuple(x) for x in rows[:, 1:].tolist()] == want.offsets, repr(t)


def test_units_by_parts_equal_the_library(library):
    encode, rnd = tokens.Encoder(tokenizer(BPE)), random.Random(5)
    latin = [chr(c) for c in [*range(0x20, 0x7F), *range(0xA0, 0x260)]]
    found = ["", " ", "  ", " a ", "\t", "'s", " 's", "it's", "I'LL", "x'll'd", ". .", "\x7f", "½²³", "aª", "ǅǈ", "漢字", "a漢"]
    found += [rnd.choice(["", " "]) + "".join(rnd.choice(rnd.choice([latin, "'stremvld.!a1"])) for _ in range(rnd.randint(1, 8))) for _ in range(20_000)]
    for u in found:
        ids = np.frombuffer(encode._encode_unit(u), np.int32).tolist()
        assert ids == library.encode(u, add_special_tokens=False).ids, repr(u)


def test_other_tokenizers_encode_whole(library, tmp_path):
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    assert tokens.Encoder(tokenizer(BPE)).by_units
    texts = ["  Two  words\n\nand a third ", "a", " a", "one two", "x  Y"]
    others = {
        "prefix": {"pre_tokenizer": pre_tokenizers.ByteLevel(add_prefix_space=True)},
        "joined": {"pre_tokenizer": pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)},
        "stripped": {"normalizer": normalizers.Strip()}, "replaced": {"normalizer": normalizers.Replace("o w", "x")},
    }
    for name, parts in others.items():
        other = Tokenizer.from_str(library.to_str())
        for part, value in parts.items():
            setattr(other, part, value)
        other.save(path := str(tmp_path / name))
        encode = tokens.Encoder(path)
        for t in texts:
            assert np.frombuffer(encode.ids(t), np.int32).tolist() == other.encode(t, add_special_tokens=False).ids, (name, t)


def test_token_attribution(spark, docs, rows, no_docs, library):
    out = token_attribution.attribute(docs, tokenizer(BPE)).collect()
    by_doc = Counter()
    for r in out:
        by_doc[r.doc_id] += r.n_tokens
    want = Counter()
    for doc_id, text, *_ in rows:
        want[doc_id] += len(library.encode(text or "", add_special_tokens=False).ids)
    assert by_doc == want
    assert sum(1 for r in out if r.doc_id == 0) == 1 and sum(1 for r in out if r.doc_id == 7) == 2
    assert token_attribution.attribute(no_docs, tokenizer(BPE)).count() == 0


def test_boundary_rules():
    spans = np.array([[0, 3], [2, 6], [4, 4], [9, 11], [3, 5]])
    starts, ends = np.array([0, 4]), np.array([4, 9])
    for rule, want in (("largest", [0, 0, 1, -1, 0]), ("first", [0, 0, 1, -1, 0]), ("last", [0, 1, 1, -1, 1])):
        got, crossing = token_attribution.allocate(spans, starts, ends, rule)
        assert got.tolist() == want and crossing.tolist() == [False, True, False, False, True]
    assert token_attribution.allocate(np.array([[3, 7]]), starts, ends, "largest")[0].tolist() == [1]


def test_attribution_to_given_sections(spark):
    df = spark.createDataFrame([(1, "Title here body text", [(0, 10), (10, 20)]), (2, "none", None)], "doc_id int, text string, s array<struct<start:int,end:int>>")
    out = token_attribution.attribute(df, tokenizer(BPE), sections_col="s").orderBy("section").collect()
    assert [r.doc_id for r in out] == [1, 1] and sum(r.n_tokens for r in out) == out[0].doc_tokens


def test_token_files(spark, docs, rows, no_docs, library):
    folder = scratch_path(spark, "test_files")
    manifest = token_frames.write(docs, folder, tokenizer(BPE), file_chars=20_000)
    assert manifest.count() > 2
    got = [tuple(r) for r in token_frames.checksums(token_frames.read(spark, manifest)).orderBy("start").collect()]
    at, want = 0, []
    seen = {(r[0], i): None for i, r in enumerate(got)}
    assert len(seen) == len(rows)
    packed = {}
    for doc_id, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        packed.setdefault(doc_id, set()).add((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for doc_id, start, n, crc in got:
        assert start == at and (n, crc) in packed[doc_id]
        at += n
        want.append(doc_id)
    assert want == sorted(want, key=lambda x: (x is not None, x or 0))
    some = token_frames.read(spark, manifest, wanted={7, 12}).collect()
    assert sorted(r.doc_id for r in some) == [7, 7, 12]
    empty = token_frames.write(no_docs, scratch_path(spark, "test_files"), tokenizer(BPE))
    assert token_frames.read(spark, empty).count() == 0


def test_frames_are_standard_and_checked(tmp_path):
    import pyarrow as pa
    import zstandard

    path = tmp_path / "x.zst"
    with open(path, "wb") as f:
        writer = token_frames.FrameWriter(f, 10)
        contents = [np.arange(i, dtype="<u4").tobytes() for i in (3, 0, 25, 4, 7)]
        for i, c in enumerate(contents):
            writer.add(i if i else None, c)
        writer.close()
    raw = path.read_bytes()
    assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == b"".join(contents)
    reader = token_frames.FrameReader(pa.OSFile(str(path)))
    assert len(reader.entries) == 4 and [x for _, _, x in reader.documents()] == contents
    assert [d for d, _, _ in reader.documents({2})] == [2]
    path.write_bytes(raw[:4] + bytes([raw[4] ^ 255]) + raw[5:])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_frames.FrameReader(pa.OSFile(str(path))).documents())


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base(text):
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = {"assign": 0, "access": 1, "hex": 2}
    return sorted(out, key=lambda x: (x[1], order[x[0]]))


def test_secret_base_spans_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op2_secret_scans"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows) and sum(r.n_assign for r in got.values()) > 0
    for r in rows:
        want = base(r.text or "")
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [got[r.doc_id][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[0] == k for x in want) for k in ("assign", "access", "hex")]
        assert set(filter(None, told.split(","))) <= set(got[r.doc_id].spans.split(","))


def test_nested_secrets(spark, docs, no_docs):
    secret = "password = hunter2hunter2"
    wrapped = {
        "url": quote(secret, safe=""), "twice": quote(quote(secret, safe=""), safe=""),
        "base64": base64.b64encode(secret.encode()).decode(), "zipped": base64.b64encode(gzip.compress(secret.encode())).decode(),
        "deep": base64.b64encode(zlib.compress(quote(base64.b64encode(secret.encode()).decode(), safe="").encode())).decode(),
        "unicode": "".join(f"\\u{ord(c):04x}" for c in secret),
    }
    for name, inner in wrapped.items():
        text = f"é😀 before {inner} after"
        start = text.index(inner)
        found, n_layers, deepest, _ = nested_secrets.nested(text)
        assert (start, 0, start + len(inner)) in found, name
        assert n_layers >= 1 and deepest >= (2 if name in ("twice", "deep") else 1)
    assert nested_secrets.scan("token=%61bcdefg") == [] and nested_secrets.nested("token=%61bcdefg")[0] == {(0, 0, 15)}
    assert nested_secrets.nested("%25" * 30)[2] < 100  # unwraps to itself in the end
    bomb = base64.b64encode(gzip.compress(b"0" * 100_000)).decode()
    assert nested_secrets.nested(bomb, limit=1000)[3] == 1
    assert nested_secrets.find(no_docs).count() == 0
    out = {r.doc_id: r for r in nested_secrets.find(docs).collect()}
    assert out[0].spans == "" and out[1].n_hex == 0


SECRET = "password = hunter2hunter2"


def planted(inner, text=None):
    """The nested layers of a text give the assignment at the place of ``inner``."""
    text = text or f"é😀 before {inner} after"
    start = text.index(inner)
    return (start, 0, start + len(inner)) in nested_secrets.nested(text)[0]


def test_every_compressed_layer_is_opened():
    b64 = lambda raw: base64.b64encode(raw).decode()
    secret = SECRET.encode()
    for level in range(10):
        assert planted(b64(zlib.compress(secret, level))), level
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
        assert planted(b64(pack(b"nothing here") + pack(secret))), pack
        assert planted(b64(pack(secret[:12]) + pack(secret[12:]))), pack
        raw = pack(b"nothing here" * 9) + pack(secret)
        assert planted("".join(f"%{b:02x}" for b in raw)) and planted("".join(f"\\x{b:02x}" for b in raw)), pack
        assert planted("".join(f"\\u{b:04x}" for b in raw)), pack
        mixed = quote(raw, safe="")
        assert planted(mixed) and any(k == 0 for _, k, _ in nested_secrets.nested(f"https://h/?q={mixed}&r=1")[0]), pack
        assert any(k == 0 for _, k, _ in nested_secrets.nested(f"data = {raw!r}")[0]), pack
    raw = secret
    for _ in range(150):
        raw = gzip.compress(raw)
    assert planted(b64(raw))


def test_bad_neighbours_do_not_hide_a_layer():
    b64 = lambda raw: base64.b64encode(raw).decode()
    secret = SECRET.encode()
    for payload in (b64(secret), b64(zlib.compress(secret, 3))):
        for before in ("https://h/", "payload_", "a/b-c/", "x_y_"):
            assert planted(payload, f"go {before}{payload} on"), before
        for before in ("", "a", "ab", "abc", "https://h/"):
            for after in ("", "/x", "_v2", "-abc", "a"):
                found = nested_secrets.nested(f"go {before}{payload.rstrip('=')}{after} on")[0]
                assert any(k == 0 for _, k, _ in found), (payload, before, after)
    for bad in (b"\x00", b"\x1b[0m", b"\xe9", b"\xff\xfe"):
        for raw in (bad + b" " + secret, secret + b" " + bad, secret + b" " + bad + b" x"):
            assert planted(b64(raw)) and planted(b64(gzip.compress(raw))), raw
            run = "".join(f"%{b:02X}" for b in raw)
            assert any(k == 0 for _, k, _ in nested_secrets.nested(f"a {run} b")[0]), raw
    run = "".join(f"\\u{ord(c):04x}" for c in SECRET)
    assert nested_secrets.nested("\\ud800" + run)[0] == nested_secrets.nested("\\u0041" + run)[0] != set()
    assert nested_secrets.nested("\\Uffffffff" + run)[0] != set()


def test_large_layers_are_scanned_whole():
    b64 = lambda raw: base64.b64encode(raw).decode()
    secret, rnd = SECRET.encode(), random.Random(7)
    noise = b64(rnd.randbytes(600)).replace("=", "").encode()
    wraps = {
        "plain": lambda x: x, "url": lambda x: "".join(f"%{c:02x}" for c in x).encode(), "base64": base64.b64encode, "zip": lambda x: b64(zlib.compress(x, 4)).encode(),
        "unicode": lambda x: "".join(f"\\u{c:04x}" for c in x).encode(), "hexed": lambda x: "".join(f"\\x{c:02x}" for c in gzip.compress(x)).encode(),
        "urlzip": lambda x: quote(bz2.compress(x), safe="").encode(), "raw": lambda x: gzip.compress(x),
    }
    for a, outer in wraps.items():
        for b, inner in wraps.items():
            for gap, fill in ((b"~", noise), (b"\n", b"word\n" * 300)):
                layer = outer(fill + gap + inner(fill + gap + secret + gap + fill))
                text = "x " + b64(gzip.compress(b"0\n" * 600 + layer)) + " y"
                whole, pieces = nested_secrets.nested(text), nested_secrets.nested(text, limit=1000)
                assert whole[3] == 0 and pieces[3] > 0, (a, b)
                assert (2, 0, len(text) - 2) in whole[0] and {f for f in whole[0] if f[1] == 0} == {f for f in pieces[0] if f[1] == 0}, (a, b, gap)
    for kind, one in ((0, b"token" + b" " * 5000 + b"=" + b" " * 5000 + b"abcdef"), (1, b"AKIA" + b"A1" * 8), (2, b"0a" * 12)):
        for at in range(970, 1030, 3):
            text = b64(zlib.compress(b"~" * at + one + b"~" * 3000))
            assert nested_secrets.nested(text, limit=1000)[0] == {(0, kind, len(text))}
    bomb = b64(gzip.compress(b"0\n" * (12 << 20) + secret))
    assert planted(bomb) and planted(b64(gzip.compress(b"~" * (24 << 20) + secret)))


def test_sentencepiece_ids_and_round_trip(spark, docs, rows, no_docs, pieces):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECES))
    out = piece_lattice.decode(piece_lattice.encode(docs, pieces, block_chars=20_000), pieces).collect()
    assert len(out) == len(rows)
    want = {}
    for doc_id, text, *_ in rows:
        want.setdefault(doc_id, []).append((sp.encode(text or ""), text or ""))
    for r in out:
        assert (list(r.ids), r.decoded) in want[r.doc_id]
    whole = piece_lattice.encode(docs, pieces, block_chars=20_000, results=tuple(piece_lattice.RESULTS)).collect()
    assert sorted((r.doc_id or -1, r.ids, r.decoded) for r in whole) == sorted((r.doc_id or -1, r.ids, r.decoded) for r in out)
    for r in whole:
        raw = b"".join(i.to_bytes(4, "little") for i in r.ids)
        assert (r.n_ids, r.ids_crc32, r.decoded_sha256) == (len(r.ids), zlib.crc32(raw), hashlib.sha256(r.decoded.encode()).hexdigest())
        assert r.round_trip
    assert piece_lattice.encode(no_docs, pieces).count() == 0


def test_texts_are_cut_once(spark, pieces, monkeypatch, tmp_path):
    """Blocks over partitions that are empty, hold several blocks, or one text longer than a block."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECES))
    rnd, log, cut = random.Random(9), tmp_path / "cuts", piece_lattice.keys

    def counted(text, prefix=True):
        with open(log, "a") as f:
            f.write(".")
        return cut(text, prefix)

    texts = ["".join(rnd.choice("abthe  \né漢😀aaing") for _ in range(rnd.randint(0, 120))) for _ in range(40)]
    texts += [None, "", "a" * 200, "the same", "the same", "some words " * 100]
    given = [(None if i % 15 == 0 else f"k{i // 2}", t) for i, t in enumerate(texts)]
    monkeypatch.setattr(piece_lattice, "keys", counted)
    for n in (1, 3, 60):
        log.write_text("")
        df = spark.createDataFrame(spark.sparkContext.parallelize(given, n), "doc_id string, text string")
        out = piece_lattice.encode(df, pieces, block_chars=400, results=("ids", "decoded", "round_trip")).collect()
        want = [(k or "", sp.encode(t or ""), t or "", True) for k, t in given]
        assert sorted((r.doc_id or "", list(r.ids), r.decoded, r.round_trip) for r in out) == sorted(want)
        assert len(log.read_text()) == len(given)


def test_long_chunks_equal_the_library(pieces):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECES))
    rnd = random.Random(5)
    for _ in range(300):
        text = "".join(rnd.choice("abthe  \né漢😀aaing") for _ in range(rnd.randint(0, 150)))
        assert [i for c in piece_lattice.chunks(text) for i in piece_lattice.encode_long(pieces, c)] == sp.encode(text)


def test_chunks_of_any_spacing():
    import re

    rnd = random.Random(8)
    for _ in range(2000):
        text = "".join(rnd.choice("ab  ▁\n") for _ in range(rnd.randint(0, 9)))
        for prefix in (True, False):
            marked = ("▁" if prefix and text else "") + text.replace(" ", "▁")
            assert piece_lattice.chunks(text, prefix) == re.findall("▁*[^▁]+|▁+", marked)


def test_merges_of_a_bpe_model(spark, pieces):
    """Words with many late pieces, where one pass over the edges is not enough, and unknown characters."""
    rnd = random.Random(7)
    late = sorted(piece_lattice.late_pieces(pieces))
    words = {"".join(rnd.choice("▁abthe\né漢😀aaing") for _ in range(rnd.randint(1, piece_lattice.LONG_CHUNK))) for _ in range(150)}
    words |= {"".join(rnd.sample(late, 3)) for _ in range(300)}
    df = spark.createDataFrame([(len(w) % 3, w) for w in words], "bucket long, word string").repartition("bucket")
    got = {r.word: list(r.ids) for r in piece_lattice.lattice_ids(df, pieces).collect()}
    for w in words:
        assert got[w] == piece_lattice.encode_long(pieces, w)
        assert got[w] == [i for u in piece_lattice.units(pieces, [w])[0] for i in piece_lattice.encode_long(pieces, u)]


def test_viterbi_of_a_unigram_model(spark):
    scores = {"a": (0, -3.0), "b": (1, -3.1), "ab": (2, -3.5), "ba": (3, -3.2), "aba": (4, -6.0), "▁": (5, -2.0), "▁a": (6, -2.5)}
    model = piece_lattice.Model(True, ("a", "b", "ab", "ba", "aba", "▁", "▁a"), scores, (), 7, True)
    rnd = random.Random(2)
    words = sorted({"▁" + "".join(rnd.choice("abz") for _ in range(rnd.randint(0, 9))) for _ in range(60)})
    df = spark.createDataFrame([(0, w) for w in words], "bucket long, word string").repartition("bucket")
    got = {r.word: list(r.ids) for r in piece_lattice.lattice_ids(df, model).collect()}

    def best(word):
        if not word:
            return 0.0
        worst = min(s for _, s in scores.values()) - 10.0
        options = [scores[word[:n]][1] + best(word[n:]) for n in range(1, 4) if word[:n] in scores]
        return max([*options, *([worst + best(word[1:])] if word[0] not in scores else [])])

    by_id = {i: s for i, s in scores.values()}
    for w in words:
        assert got[w] == piece_lattice.encode_long(model, w)
        assert sum(by_id.get(i, min(by_id.values()) - 10.0) for i in got[w]) == pytest.approx(best(w))


def test_queries_keep_every_row(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op3_token_files", "op5_sentencepiece"):
        assert QUERIES[name](spark, sf).select("doc_id").distinct().count() == n
    assert QUERIES["op1_token_counts"](spark, sf).select(F.countDistinct("doc_id")).first()[0] == n
