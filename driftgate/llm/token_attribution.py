"""Token counts by offset-mapped attribution.

A document is encoded once, whole, with character offsets. Its sections are character intervals
(its lines, or a column of intervals of its own), and token spans are interval-joined to them.
Both lists belong to the row and are sorted, so the join is a binary search inside the row and
no token is shuffled. A token that crosses a boundary is allocated by an explicit rule:

- ``largest``: to the section with the largest part of it, the earliest of equals;
- ``first`` / ``last``: to the section where it begins / ends.

Defined results: a null or empty text has one section, empty, with no tokens; tokens that share
a character's bytes have the same span and the same section; tokens outside every section are
not counted in any, but are in ``doc_tokens``; repeated rows get equal results, one each; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.llm import common, tokens

RULES = ("largest", "first", "last")
_SCHEMA = "id {id}, section int, start int, end int, n_tokens long, n_crossing long, doc_tokens long"


def allocate(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token span (-1: none) and whether the span crosses a boundary.
    Sections are sorted and do not overlap."""
    if not len(starts):
        return np.full(len(spans), -1), np.zeros(len(spans), bool)
    a, b = spans[:, 0], np.maximum(spans[:, 1], spans[:, 0] + 1)  # an empty span stands on a character
    first = np.searchsorted(ends, a, side="right")  # the first section that ends after the start
    last = np.searchsorted(starts, b, side="left") - 1  # the last one that starts before the end
    inside = first <= last
    crossing = inside & ((first < last) | (a < starts[np.minimum(first, len(starts) - 1)]) | (b > ends[np.maximum(last, 0)]))
    out = np.where(inside, first if rule != "last" else last, -1)
    if rule == "largest":
        for i in np.flatnonzero(inside & (first < last)):
            parts = range(first[i], last[i] + 1)
            out[i] = max(parts, key=lambda s: (min(b[i], ends[s]) - max(a[i], starts[s]), -s))
    return out, crossing


def line_bounds(text: str) -> list[tuple[int, int]]:
    """Lines with their line feed, as character intervals."""
    at = [0]
    while (found := text.find("\n", at[-1])) >= 0:
        at.append(found + 1)
    if at[-1] < len(text) or len(at) == 1:
        at.append(len(text))
    return list(zip(at, at[1:], strict=False))


def attribute(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None, rule: str = "largest") -> DataFrame:
    """One row per document and section: (id, section, start, end, n_tokens, n_crossing, doc_tokens).
    ``sections_col``: array of structs (start, end), sorted and without overlap; else lines."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    columns = [F.col(id_col).alias("id"), F.col(text_col).alias("text")]
    thin = docs.select(*columns, *([F.col(sections_col).alias("sections")] if sections_col else []))
    id_type = thin.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer_path, offsets=True)
        for batch in batches:
            own = batch.column(2).to_pylist() if sections_col else None
            at, columns = [], [[] for _ in range(6)]
            for i, text in enumerate(batch.column(1).to_pylist()):
                text = text or ""
                bounds = line_bounds(text) if own is None else [(s["start"], s["end"]) for s in own[i] or []]
                rows = encode.rows(text)
                edges = np.array(bounds, np.int64).reshape(-1, 2)
                section, crossing = allocate(rows[:, 1:], edges[:, 0], edges[:, 1], rule)
                n = len(bounds)
                at += [i] * n
                columns[0].append(np.arange(n))
                columns[1].append(edges[:, 0])
                columns[2].append(edges[:, 1])
                columns[3].append(np.bincount(section[section >= 0], minlength=n))
                columns[4].append(np.bincount(section[(section >= 0) & crossing], minlength=n))
                columns[5].append(np.full(n, len(rows)))
            flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
            kinds = [pa.int32()] * 3 + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c.astype(np.int64)).cast(t) for c, t in zip(flat, kinds, strict=True)]],
                names=["id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"],
            )

    return thin.mapInArrow(run, _SCHEMA.format(id=id_type)).withColumnRenamed("id", id_col)


common.ship(__name__)
