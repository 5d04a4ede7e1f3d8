"""Secret scans with a recursive decoding worklist.

Every whole text is scanned for three kinds of secrets. Then a worklist unwraps layers: URL
escapes and Unicode escapes are decoded in place, base64 runs become layers of their own, and a
decoded layer that is compressed (gzip, zlib, bzip2, xz; one member or several) is decompressed, as
are compressed bytes written with URL or backslash escapes. Each new layer is scanned and put on the worklist, until none is left. A layer whose content and place were seen
before is not taken again, so a layer that unwraps to itself ends.

Spans are code points of the original text. In-place decoding maps each character back to the
escape it came from; whatever lies in an encoded run is mapped to that run, or to its part from
the ``/``, ``-`` or ``_`` on after which all is text. A base64 run is decoded from each of its first
four characters on, and compressed bytes may start at any byte. What is not UTF-8 or a control
character stays in the layer, one character a byte; a layer with such ones counts in ``n_layers``
if something is found in it. A decoded finding is added if it touches a decoded character and is not already there; base findings stay.

The content of an archive that is larger than ``MAX_LAYER_BYTES`` is not held: it is scanned whole, in
pieces that end at a character which no pattern takes, and a longer stretch without one as a stream
with the unfinished match carried over. Its encoded runs and archives are read again from their
start. ``n_cut_layers`` counts the contents taken in pieces, and ``n_layers`` each piece for itself.

Defined results: a null text is empty and has no findings; repeated rows get equal results, one
each; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import binascii
import bisect
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.llm import common

KINDS = ("assign", "access", "hex")
MAX_LAYER_BYTES = 16 << 20
PIECE_BYTES = 1 << 20
MIN_BASE64 = 16

# The patterns and least lengths of the three kinds.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_MIN, _ACCESS_MIN = 6, 20

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_BASE64)
_MAGIC = ((b"\x1f\x8b", "gzip"), (b"BZh", "bzip2"), (b"\xfd7zXZ\x00", "xz"))
# Zlib headers by their rule (RFC 1950): method 8, the two bytes a multiple of 31, no dictionary.
_ZLIB = [re.escape(bytes([a])) + b"[" + re.escape(bytes(b for b in range(256) if (a << 8 | b) % 31 == 0 and not b & 32)) + b"]" for a in range(8, 128, 16)]
_START = re.compile(b"|".join([rb"\x1f\x8b\x08", rb"BZh[1-9](?:1AY&SY|\x17rE8P\x90)", rb"\xfd7zXZ\x00", *_ZLIB]))
# Bytes written with escapes: the characters that need none stand for themselves.
_URL_TOKEN = re.compile(r"(?:%[0-9A-Fa-f]{2}|[!-$&-~])+")
_URL_BYTE = re.compile(r"%(..)|()[!-~]")
_X_TOKEN = re.compile(r"""(?:\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}|\\U000000[0-9A-Fa-f]{2}|\\[abfnrtv0\\'"]|[ -\[\]-~])+""")
_X_BYTE = re.compile(r"""\\(?:x|u00|U000000)(..)|\\([abfnrtv0\\'"])|[ -~]""")
_C_ESCAPES = dict(zip("abfnrtv0\\'\"", b"\x07\x08\x0c\n\r\t\x0b\x00\\'\"", strict=True))
_BAD = re.compile(r"[\x00-\x08\x0e-\x1f\x7f\ud800-\udfff]")  # a byte that is not UTF-8 is a lone surrogate

_EDGE = re.compile(r"[^\x20-~]")  # no pattern and no token takes one
_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
_LOOK, _TAIL = 1 << 16, 64  # bytes seen of what may be an archive; characters carried over

Finding = tuple[int, int, int]  # start, kind, end
Bytes = Callable[[], Iterator[bytes]]  # content read anew by each call
Texts = Callable[[], Iterator[str]]


def scan(text: str) -> list[Finding]:
    """The base findings: leftmost non-overlapping matches of each kind that are long enough."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_MIN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= _ACCESS_MIN]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A decoded text and where its characters come from. ``edges`` are the positions at which
    the mapping changes: (own start, original start, original end); a run whose original interval
    is None moves one to one, others map to the whole interval."""

    def __init__(self, text: str, edges: list[tuple[int, int, int | None]]):
        self.text, self.edges = text, edges
        self.starts = [e[0] for e in edges]

    def place(self, start: int, end: int) -> tuple[int, int, bool]:
        """The original interval of [start, end) and whether it touches a decoded character."""
        i = bisect.bisect_right(self.starts, start) - 1
        j = bisect.bisect_right(self.starts, max(start, end - 1)) - 1
        own, at, upto = self.edges[i]
        first = at + start - own if upto is None else at
        own, at, upto = self.edges[j]
        last = at + end - own if upto is None else upto
        return first, last, any(e[2] is not None for e in self.edges[i : j + 1])


def in_place(layer: Layer, pattern: re.Pattern, decoded) -> Layer | None:
    """The layer with every match replaced by its decoded characters (null: there is no match)."""
    out: list[str] = []
    edges: list[tuple[int, int, int | None]] = []
    at = size = 0

    def copy(upto: int) -> None:
        nonlocal at, size
        while at < upto:  # keep the runs of the layer below
            i = bisect.bisect_right(layer.starts, at) - 1
            stop = min(upto, layer.starts[i + 1] if i + 1 < len(layer.starts) else upto)
            own, origin, end = layer.edges[i]
            edges.append((size, origin + at - own if end is None else origin, end))
            out.append(layer.text[at:stop])
            size += stop - at
            at = stop

    changed = False
    for m in pattern.finditer(layer.text):
        pieces = decoded(m[0])
        changed = True
        copy(m.start())
        for piece, a, b in pieces:  # one character and its escape
            first, last, _ = layer.place(m.start() + a, m.start() + b)
            edges.append((size, first, last))
            out.append(piece)
            size += len(piece)
        at = m.end()
    if not changed:
        return None
    copy(len(layer.text))
    return Layer("".join(out), edges or [(0, 0, None)])


def url_pieces(run: str) -> list[tuple[str, int, int]]:
    out, at = [], 0
    for ch in text_of(bytes.fromhex(run.replace("%", ""))):
        n = 3 * len(ch.encode("utf-8", "surrogateescape"))
        out.append((ch, at, at + n))
        at += n
    return out


def unicode_pieces(run: str) -> list[tuple[str, int, int]]:
    out: list[tuple[str, int, int]] = []
    for m in re.finditer(r"\\(?:u(....)|U(........)|x(..))", run):
        code = int(m[1] or m[2] or m[3], 16)
        if out and 0xDC00 <= code < 0xE000 and 0xD800 <= ord(out[-1][0]) < 0xDC00:
            high = out.pop()
            out.append((chr(0x10000 + ((ord(high[0]) - 0xD800) << 10) + code - 0xDC00), high[1], m.end()))
        elif code > 0x10FFFF:  # no character: the escape stays
            out += [(ch, m.start() + i, m.start() + i + 1) for i, ch in enumerate(m[0])]
        else:
            out.append((chr(code), m.start(), m.end()))
    return out


def packed(head: bytes) -> str | None:
    """How the bytes that start so are compressed."""
    kind = next((k for magic, k in _MAGIC if head.startswith(magic)), None)
    return kind or ("zlib" if _START.match(head) else None)


def expand(pieces: Iterator[bytes], used: list[int], size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The content of compressed bytes in pieces of at most ``size``: one member after the other, up
    to the end of the input, to what is no member, or to what does not decompress. ``used`` gets
    the number of input bytes of each whole member."""
    data, pulled, begun = b"", 0, 0
    while True:
        while len(data) < 6 and (more := next(pieces, None)) is not None:
            data += more
            pulled += len(more)
        kind = packed(data)
        if kind is None:
            return
        if kind in ("gzip", "zlib"):
            opener = zlib.decompressobj(31 if kind == "gzip" else 15)
        else:
            opener = bz2.BZ2Decompressor() if kind == "bzip2" else lzma.LZMADecompressor(lzma.FORMAT_XZ)
        while not opener.eof:
            try:
                out = opener.decompress(data, size)
            except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
                return
            data = getattr(opener, "unconsumed_tail", b"")
            if out:
                yield out
            if not opener.eof and not data and len(out) < size:
                if (data := next(pieces, None)) is None:  # the input ends within a member
                    return
                pulled += len(data)
        data = opener.unused_data
        if kind == "xz":  # a stream may be padded with zeros
            while not (data := data.lstrip(b"\x00")) and (more := next(pieces, None)) is not None:
                data = more
                pulled += len(more)
        used.append(pulled - len(data) - begun)
        begun = pulled - len(data)


def slices(raw: bytes, start: int = 0) -> Iterator[bytes]:
    return (raw[i : i + (1 << 16)] for i in range(start, len(raw), 1 << 16))


def later(source: Bytes, at: int) -> Iterator[bytes]:
    """The pieces from byte ``at`` on."""
    for piece in source():
        if at < len(piece):
            yield piece[at:]
        at = max(0, at - len(piece))


def windows(source: Bytes) -> Iterator[tuple[bytes, int, int]]:
    """(window, its place, how many of its bytes are no start of the next window)."""
    data, base = b"", 0
    for piece in source():
        data += piece
        if len(data) >= 4 * _LOOK:
            yield data, base, len(data) - _LOOK
            base, data = base + len(data) - _LOOK, data[-_LOOK:]
    yield data, base, len(data)


class Room:
    """What is held of a content at most, and how many contents were larger."""

    def __init__(self, limit: int):
        self.limit, self.piece, self.n_cut = limit, min(limit, PIECE_BYTES), 0

    def hold(self, packed_bytes: Bytes) -> tuple[bytes | Bytes, bytes, int] | None:
        """The content of compressed bytes, held or to be read anew; its digest; how many bytes
        its whole members take."""
        used: list[int] = []
        out, key, size = bytearray(), hashlib.blake2b(digest_size=16), 0
        for piece in expand(packed_bytes(), used):
            key.update(piece)
            size += len(piece)
            if size <= self.limit:
                out += piece
            else:
                out = bytearray()
        if size > self.limit:
            self.n_cut += 1
            return (lambda: expand(packed_bytes(), [])), key.digest(), sum(used)
        return (bytes(out), key.digest(), sum(used)) if size else None


def digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def contents(source: Bytes, room: Room, seen: set, place: tuple[int, int] | None = None) -> Iterator[tuple[bytes | Bytes, int, int]]:
    """What compressed bytes anywhere in ``source`` hold, and those in these: (content, start,
    end), with the place in the source or the given one. A content seen at its place is left out."""
    work: list[tuple[Bytes, tuple[int, int] | None]] = [(source, place)]
    while work:
        data, place = work.pop()
        done = 0
        for window, base, mine in windows(data):
            for m in _START.finditer(window):
                if m.start() >= mine:
                    break
                if (start := base + m.start()) < done:
                    continue
                feed = lambda w=window, i=m.start(), d=data, end=base + len(window): chain(slices(w, i), later(d, end))
                if (held := room.hold(feed)) is None:
                    continue
                inner, key, n_used = held
                end = start + n_used if n_used else base + len(window)
                if n_used or callable(inner) or plain(text_of(inner)):
                    done = end
                at = place or (start, end)
                if (key, *at) not in seen:
                    seen.add((key, *at))
                    yield inner, *at
                    work.append((inner if callable(inner) else lambda x=inner: iter((x,)), at))


def texts_of(content: bytes | Bytes, room: Room, seen: set, at: tuple[int, int]) -> Iterator[str]:
    """A content as text, in pieces if it is not held."""
    if callable(content):
        yield from in_pieces(lambda: decoded(content), room, seen, at)
    else:
        yield text_of(content)


def decoded(source: Bytes) -> Iterator[str]:
    decoder = codecs.getincrementaldecoder("utf-8")("surrogateescape")
    for piece in source():
        yield decoder.decode(piece)
    yield decoder.decode(b"", True)


def in_pieces(texts: Texts, room: Room, seen: set, at: tuple[int, int]) -> Iterator[str]:
    """A text in pieces that no match crosses; a long stretch that has no place to cut as what its
    matches and layers are."""
    rest, base, long = "", 0, None  # the text not yet given, its place, where a long stretch began
    for text in chain(texts(), [None]):
        ends = text is None
        rest += text or ""
        if long is not None:
            edge = _EDGE.search(rest)
            upto = edge.start() if edge else len(rest)
            base, rest = base + upto, rest[upto:]
            if not edge and not ends:
                continue
            yield from stretched(lambda a=long, b=base: between(texts, a, b), room, seen, at)
            long = None
        if len(rest) < room.piece and not ends:
            continue
        edge = None if ends else _EDGE.search(rest[::-1])
        if ends or edge:
            upto = len(rest) - edge.start() if edge else len(rest)
            if upto:
                yield rest[:upto]
            base, rest = base + upto, rest[upto:]
        if len(rest) >= room.piece:
            long, base, rest = base, base + len(rest), ""


def between(texts: Texts, a: int, b: int) -> Iterator[str]:
    at = 0
    for text in texts():
        if at >= b:
            return
        if part := text[max(0, a - at) : b - at]:
            yield part
        at += len(text)


def stretched(texts: Texts, room: Room, seen: set, at: tuple[int, int]) -> Iterator[str]:
    """The matches of a long stretch of plain ASCII, and the texts of its layers."""
    yield from matches(texts())
    if any("%" in t for t in texts()):
        yield from in_stream(lambda: url_bytes(texts()), room, seen, at)
    if any("\\" in t for t in texts()):
        yield from in_pieces(lambda: unicode_texts(texts()), room, seen, at)
        for inner, *_ in contents(lambda: backslash_bytes(texts()), room, seen, at):
            yield from texts_of(inner, room, seen, at)
    for a, b in runs(texts()):
        run = lambda a=a, b=b: between(texts, a, b)
        if b - a <= room.piece:
            yield "".join(run())
        else:
            for shift in range(4):
                yield from in_stream(lambda r=run, s=shift: base64_stream(r(), s), room, seen, at)


def in_stream(source: Bytes, room: Room, seen: set, at: tuple[int, int]) -> Iterator[str]:
    yield from texts_of(source, room, seen, at)
    for inner, *_ in contents(source, room, seen, at):
        yield from texts_of(inner, room, seen, at)


def matches(texts: Iterator[str]) -> Iterator[str]:
    """The start of a match of each kind that the text has. Any number of spaces is one."""
    carry, skip, left = "", 0, {0, 1, 2}
    for piece in texts:
        text = re.sub(r"\x20{2,}", " ", carry + piece)
        done = skip
        for m in _ASSIGN.finditer(text, skip) if 0 in left else ():
            if len(m[2]) >= _ASSIGN_MIN:
                yield m[0][: m.start(2) - m.start() + _ASSIGN_MIN]
                left.discard(0)
                break
            if m.end() < len(text):
                done = m.end()
        for kind, pattern, least in ((1, _ACCESS, _ACCESS_MIN), (2, _HEX, 24)):
            if kind in left and (m := next((m for m in pattern.finditer(text) if len(m[0]) >= least), None)):
                yield m[0][:least]
                left.discard(kind)
        if not left:
            return
        carry = text[-_TAIL:]
        skip = max(0, done - (len(text) - len(carry)))


def runs(texts: Iterator[str]) -> Iterator[tuple[int, int]]:
    """The places of the base64 runs."""
    at, begun, end = 0, 0, 0
    for text in texts:
        for m in _RUN.finditer(text):
            if at + m.start() > end or end == 0:
                if end - begun >= MIN_BASE64:
                    yield begun, end
                begun = at + m.start()
            end = at + m.end()
        at += len(text)
    if end - begun >= MIN_BASE64:
        yield begun, end


def base64_stream(texts: Iterator[str], shift: int) -> Iterator[bytes]:
    rest, skip = "", shift
    for text in texts:
        skip, rest = max(0, skip - len(text)), rest + text[skip:]
        upto = len(rest) // 4 * 4
        if upto:
            yield base64_bytes(rest[:upto], 0)
        rest = rest[upto:]
    yield base64_bytes(rest, 0)


def url_bytes(texts: Iterator[str]) -> Iterator[bytes]:
    rest = ""
    for text in texts:
        rest += text
        upto = rest.rfind("%", max(0, len(rest) - 2))
        upto = len(rest) if upto < 0 else upto
        yield unquote_to_bytes(rest[:upto])
        rest = rest[upto:]
    yield unquote_to_bytes(rest)


def unicode_texts(texts: Iterator[str]) -> Iterator[str]:
    rest = ""
    for text in chain(texts, [None]):
        rest += text or ""
        upto = rest.find("\\", max(0, len(rest) - 24)) if text is not None else -1
        upto = len(rest) if upto < 0 else upto
        if half := re.search(r"\\(?:u|U0000)[dD][89abAB]..\Z", rest[max(0, upto - 10) : upto]) if text is not None else None:
            upto -= len(half[0])  # half of a pair
        yield _UNICODE.sub(lambda m: "".join(p[0] for p in unicode_pieces(m[0])), rest[:upto])
        rest = rest[upto:]


def backslash_bytes(texts: Iterator[str]) -> Iterator[bytes]:
    rest = ""
    for text in chain(texts, [None]):
        rest += text or ""
        out, upto = bytearray(), 0
        for m in _X_BYTE.finditer(rest):
            if text is not None and m.start() > len(rest) - 10:
                break
            out.append(byte_of(m))
            upto = m.end()
        yield bytes(out)
        rest = rest[upto:]


def byte_of(m: re.Match) -> int:
    return _C_ESCAPES[m[2]] if m[2] else int(m[1], 16) if m[1] else ord(m[0])


def escaped(text: str, token: re.Pattern, one: re.Pattern, room: Room) -> Iterator[tuple[bytes | Bytes, int, int]]:
    """``contents`` of the tokens of escapes and plain characters in a text, with the place in it."""
    for m in token.finditer(text):
        if "%" not in m[0] and "\\" not in m[0]:
            continue
        raw, at = bytearray(), []
        for e in one.finditer(m[0]):
            at.append(m.start() + e.start())
            raw.append(byte_of(e))
        at.append(m.end())
        for inner, start, end in contents(lambda x=bytes(raw): iter((x,)), room, set()):
            yield inner, at[start], at[min(end, len(raw))]


def text_of(raw: bytes) -> str:
    """UTF-8 with a lone surrogate for each byte that is none."""
    return raw.decode("utf-8", "surrogateescape")


def plain(text: str) -> bool:
    return bool(text) and not _BAD.search(text)


def base64_bytes(run: str, shift: int) -> bytes:
    """A run decoded from its character ``shift`` on; a single character left over is dropped."""
    body = run.rstrip("=")[shift:].replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    return binascii.a2b_base64(body + "=" * (-len(body) % 4))


def payload(run: str, shift: int, raw: bytes, text: str) -> tuple[int, int] | None:
    """The first part of a run (after ``/``, ``-`` or ``_``) from which all is plain, if what is
    before is not: (its first character in ``text``, its place in the run)."""
    bad = _BAD.search(text[::-1])
    if bad is None:
        return None
    clean = len(text) - bad.start()
    before = len(text[:clean].encode("utf-8", "surrogateescape"))
    for m in re.compile("[/_-]").finditer(run, shift + -(-before // 3) * 4 - 1 if before else 0):
        at = (m.end() - shift) // 4 * 3
        if (m.end() - shift) % 4 == 0 and before <= at < len(raw):
            return clean + len(text_of(raw[before:at])), m.end()
    return None


def base64_layers(layer: Layer, room: Room) -> Iterator[Layer]:
    """The layers of the base64 runs. A payload may start anywhere in a run, so each run is decoded
    from each of its first four characters on."""
    for m in _BASE64.finditer(layer.text):
        for shift in range(4):
            raw = base64_bytes(m[0], shift)
            text = text_of(raw)
            first, last, _ = layer.place(m.start() + shift, m.end())
            edges: list[tuple[int, int, int | None]] = [(0, first, last)]
            if part := payload(m[0], shift, raw, text):
                edges.append((part[0], *layer.place(m.start() + part[1], m.end())[:2]))
            yield Layer(text, edges)
            for inner, start, _ in contents(lambda x=raw: iter((x,)), room, set()):
                first, last, _ = layer.place(m.start() + shift + start * 4 // 3, m.end())
                for piece in texts_of(inner, room, set(), (first, last)):
                    yield Layer(piece, [(0, first, last)])


def layers_in(layer: Layer, room: Room) -> Iterator[Layer]:
    """The layers that lie directly in a layer."""
    for mark, pattern, pieces in (("%", _URL, url_pieces), ("\\", _UNICODE, unicode_pieces)):
        if mark in layer.text and (inner := in_place(layer, pattern, pieces)):
            yield inner
    for mark, token, one in (("%", _URL_TOKEN, _URL_BYTE), ("\\", _X_TOKEN, _X_BYTE)):
        for inner, start, end in escaped(layer.text, token, one, room) if mark in layer.text else ():
            first, last, _ = layer.place(start, end)
            for piece in texts_of(inner, room, set(), (first, last)):
                yield Layer(piece, [(0, first, last)])
    yield from base64_layers(layer, room)


def nested(text: str, limit: int = MAX_LAYER_BYTES) -> tuple[set[Finding], int, int, int]:
    """Findings of all decoded layers, the number of layers, the deepest one and how many contents
    were taken in pieces because they are larger than ``limit``."""
    found: set[Finding] = set()
    seen: set[tuple[bytes, int, int]] = set()
    n_layers = deepest = 0
    room = Room(limit)
    work = [layers_in(Layer(text, [(0, 0, None)]), room)]
    while work:
        if (inner := next(work[-1], None)) is None:
            work.pop()
            continue
        first, last, _ = inner.place(0, len(inner.text))
        key = (digest(inner.text.encode("utf-8", "surrogatepass")), first, last)
        if key in seen:
            continue
        seen.add(key)
        secrets = scan(inner.text)
        if secrets or plain(inner.text):
            n_layers, deepest = n_layers + 1, max(deepest, len(work))
        for start, kind, end in secrets:
            a, b, inside = inner.place(start, end)
            if inside:
                found.add((a, kind, b))
        work.append(layers_in(inner, room))
    return found, n_layers, deepest, room.n_cut


def told(findings: list[Finding]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in findings)


_SCHEMA = (
    "id {id}, n_assign long, n_access long, n_hex long, base_spans string, spans string, "
    "n_layers long, deepest long, n_cut_layers long"
)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, n_assign, n_access, n_hex, base_spans, spans, n_layers, deepest,
    n_cut_layers); spans as kind:start:end by start, then kind, comma-joined."""
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = _SCHEMA.format(id=thin.schema["id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = scan(text or "")
                more, *counts = nested(text or "")
                each = [sum(f[1] == k for f in base) for k in range(len(KINDS))]
                rows.append((*each, told(base), told(sorted(set(base) | more)), *counts))
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 3
            names = ["id", "n_assign", "n_access", "n_hex", "base_spans", "spans", "n_layers", "deepest", "n_cut_layers"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], names=names)

    return thin.mapInArrow(run, schema).withColumnRenamed("id", id_col)


common.ship(__name__)
