"""Token ids and offsets of whole texts with the tokenizers library, at the speed of a word cache.

A byte-level BPE tokenizer with the usual split pattern never joins a word with the one before:
a piece starts at white space followed by something else. So a text is cut into units (a run of
non-space with the single space before it, and what is left of longer runs of white space), the
library encodes each distinct unit once, and a text's ids are its units' ids in order. This
equals encoding the text whole (tested over all of Unicode's white space). A text that holds an
added token's string, or one of the ASCII separators 0x1C to 0x1F on which definitions of white
space differ, is encoded whole. So is every text with a tokenizer that is not known to be of that
kind (``by_units``).

Where no offsets are asked for, a new unit of printable characters up to U+024F is itself cut by the
split pattern (below that code point the classes of characters are the same in all Unicode versions
since 5.0) and each part goes straight to the library's BPE model, which spares the library's own
splitting and its bookkeeping of offsets. Other units go through the library's ``encode``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import unicodedata
from array import array

import numpy as np

from driftgate.llm import common

#: Distinct units in a generation of a worker's cache; it holds two generations.
CACHE_UNITS = 300_000
_RUNS = re.compile(r"(\s{2,})")
_SEPARATORS = re.compile("[\x1c-\x1f]")

_LATIN = [*range(0x21, 0x7F), *range(0xA1, 0x250)]
_LETTERS, _NUMBERS = (re.escape("".join(chr(c) for c in _LATIN if unicodedata.category(chr(c))[0] == kind)) for kind in "LN")
_LATIN_WORD = re.compile("[\x21-\x7e\xa1-\u024f]+")
#: The built-in split pattern of byte-level BPE, for units of such characters.
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^ {_LETTERS}{_NUMBERS}]+")


def _byte_letters() -> dict[int, int]:
    """Byte -> character of the byte-level alphabet: printable Latin-1 as it is, the rest from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return dict(zip(shown, shown, strict=True)) | {b: 0x100 + i for i, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()
_SPACE = chr(_BYTE_LETTERS[0x20])


class _Units(dict):
    """Unit -> packed int32 rows (id, start, end), or ids only; offsets within the unit. A full
    generation becomes the older one; units still in use come back from there."""

    def __init__(self, encode, prefix: str):
        super().__init__()
        self.encode, self.prefix, self.older = encode, prefix, {}

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= CACHE_UNITS:
            self.older = dict(self)
            self.clear()
        packed = self.older.get(unit)
        self[unit] = packed = self.encode(self.prefix + unit) if packed is None else packed
        return packed


def by_units(tokenizer) -> bool:
    """Whether a tokenizer encodes a text's units one by one as it encodes the text: byte-level BPE
    with the built-in split pattern and nothing that looks at or changes the whole text."""
    split = json.loads(tokenizer.pre_tokenizer.__getstate__()) if tokenizer.pre_tokenizer else {}
    usual = split.get("type") == "ByteLevel" and split.get("use_regex") is True and split.get("add_prefix_space") is False
    added = tokenizer.get_added_tokens_decoder().values()
    return (
        usual and tokenizer.normalizer is None and type(tokenizer.model).__name__ == "BPE" and not tokenizer.model.dropout
        and tokenizer.truncation is None and tokenizer.padding is None and not any(t.lstrip or t.rstrip for t in added)
    )


class Encoder:
    def __init__(self, path: str, offsets: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.offsets = Tokenizer.from_file(path), offsets
        self.by_units = by_units(self.tokenizer)
        self.added = [str(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        new = self._encode if offsets or not self.by_units else self._encode_unit
        self.plain, self.spaced, self.model = _Units(new, ""), _Units(new, " "), self.tokenizer.model

    def _encode(self, text: str) -> bytes:
        if not self.offsets:
            (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            return array("i", found.ids).tobytes()
        found = self.tokenizer.encode(text, add_special_tokens=False)
        rows = np.empty((len(found.ids), 3), np.int32)
        rows[:, 0] = found.ids
        rows[:, 1:] = np.array(found.offsets, np.int32).reshape(-1, 2)
        return rows.tobytes()

    def _encode_unit(self, unit: str) -> bytes:
        """The packed ids of a unit, by its parts."""
        word = unit[1:] if unit[:1] == " " else unit
        simple = word.isascii()
        if not (simple and word.isprintable() and " " not in word) and not _LATIN_WORD.fullmatch(word):
            return self._encode(unit)
        if not word.isalpha():
            parts = _PARTS.findall(unit)
            if len(parts) > 1:
                return b"".join([self.spaced[p[1:]] if p[0] == " " else self.plain[p] for p in parts])
        letters = unit.replace(" ", _SPACE) if simple else unit.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array("i", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _units(self, text: str) -> tuple[list[bytes], list[int]]:
        """The packed units of a text and, with offsets, their lengths in characters."""
        plain, spaced, packed, lengths = self.plain, self.spaced, [], []
        parts = _RUNS.split(text)
        pending = False  # the last space of a run belongs to the unit after it
        for i in range(0, len(parts), 2):
            for k, line in enumerate(parts[i].split("\n")):
                if k:
                    packed.append(plain["\n"])
                    lengths.append(1)
                words = line.split(" ")
                first, rest = words[0], words[1:]
                if first:
                    packed.append((spaced if pending else plain)[first])
                    lengths.append(len(first) + pending)
                    pending = False
                packed += map(spaced.__getitem__, rest)
                if self.offsets:
                    lengths += [len(w) + 1 for w in rest]
            if i + 1 < len(parts):
                run, last = parts[i + 1], i + 2 == len(parts) - 1 and not parts[i + 2]
                pieces = [run] if last else [run[:-1]] if run[-1] == " " else [run[:-1], run[-1]]
                pending = not last and run[-1] == " "
                packed += [plain[p] for p in pieces]
                lengths += map(len, pieces)
        return packed, lengths

    def _whole(self, text: str) -> bool:
        return not self.by_units or bool(_SEPARATORS.search(text)) or any(a in text for a in self.added)

    def ids(self, text: str) -> bytes:
        """The ids as packed int32."""
        return self._encode(text) if self._whole(text) else b"".join(self._units(text)[0])

    def rows(self, text: str) -> np.ndarray:
        """Rows (id, start, end) in characters of the text; for an encoder with offsets."""
        if self._whole(text):
            return np.frombuffer(self._encode(text), np.int32).reshape(-1, 3)
        packed, lengths = self._units(text)
        rows = np.frombuffer(b"".join(packed), np.int32).reshape(-1, 3).copy()
        starts = np.cumsum([0, *lengths[:-1]]) if lengths else np.zeros(0, np.int64)
        rows[:, 1:] += np.repeat(starts, [len(p) // 12 for p in packed]).astype(np.int32)[:, None]
        return rows


def encoder(path: str, offsets: bool = False) -> Encoder:
    """This worker process's encoder, kept between tasks."""
    kept = sys.modules.setdefault("_driftgate_worker", types.ModuleType("_driftgate_worker"))
    name = f"encoder {path} {offsets}"
    if name not in kept.__dict__:
        kept.__dict__[name] = Encoder(path, offsets)
    return kept.__dict__[name]


common.ship(__name__)
