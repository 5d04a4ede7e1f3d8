"""Conversation structure repair by depth-first branch and bound.

A repaired conversation has role initials ``(s?(ua)+)?``. Each row is kept (cost 0), gets the role
user or assistant (3), or is deleted (4; required for a blank or duplicate row); an empty user or
assistant row may be inserted anywhere (3); a truncated row that stays costs 3 more. The cheapest
edits win, of equally cheap ones those with the ASCII-least string of initials (D, I, K, R).

The search runs over nodes (rows consumed, state) with an explicit stack. A state says what the
output so far ends in, so it alone decides what may follow. ``_to_go`` gives the lower bound of a
suffix: what its rows cost at least from a state on, forgetting the order of equally cheap edits.
A prefix is dropped if its cost and bound exceed the incumbent's cost, if they are equal and its
edits are ASCII-greater, or if the node's dominance table holds a prefix at least as good. The
search ends with an empty stack, which proves the incumbent optimal. Children are pushed so that the
least bound, then the ASCII-least edit, is tried first; the bound is tight in cost, so the first
leaf is mostly the optimum and the rest is pruned at once.

Rows travel in one shuffle by conversation and one sort by turn, and are read as a stream: the
conversation is cut into segments of bounded rows and text, each solved for every state that can
stand before and after it, and the pieces are joined by (cost, edits), with one running SHA-256 a
state. So a conversation of any length, be it a third of all rows, needs the memory of a segment and
one character a row for the edits, which are part of the result. (Two pieces of equal cost that
consume the same rows are never prefixes of each other, so the least whole is made of least pieces.)
The one task that reads a hot conversation follows from the result: a SHA-256 is sequential.

Defined results: a null role or text counts as one space. Null turns come first; rows of one turn are
ordered by role, then by the SHA-256 of the text; equal rows are repeats. A null id is a conversation of its
own. An empty role has no initial, so it is never kept. An empty table gives no rows; further
columns are ignored. Turns are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftgate.llm.common import ship

#: A segment ends at this many rows or characters.
SEGMENT_ROWS = 256
SEGMENT_CHARS = 4_000_000
#: A task remembers this many searches over up to so many rows.
REMEMBERED, REMEMBERED_ROWS = 100_000, 16

# Fixed values of the contract: costs of the edits, and what counts as space and as a sentence's end.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
SENTENCE_END = (".", "!", "?")

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
_ACCEPT = (_START, _ASSISTANT)
#: state -> initials that may follow, with the state they lead to.
_NEXT = {
    _START: {"s": _SYSTEM, "u": _USER},
    _SYSTEM: {"u": _USER},
    _USER: {"a": _ASSISTANT},
    _ASSISTANT: {"u": _USER},
}
_ROLE = {"u": "user", "a": "assistant"}
_PAIRS = frozenset(("su", "ua", "au"))
_FAR = 1 << 60


def _moves(code: str | None, state: int) -> list[tuple[str, int, int, bool, str]]:
    """(initial, cost, next state, row consumed, role given) in a state before a row; no code: no row left.
    A code is empty for a row that must go, else its role's initial (or a space) and ``T`` if truncated."""
    give = [(i, s) for i, s in _NEXT[state].items() if i != "s"]
    out = [("I", INSERT, s, False, _ROLE[i]) for i, s in give]
    if code is None:
        return out
    out.append(("D", DELETE, state, True, ""))
    if code:
        extra = TRUNCATED if len(code) == 2 else 0
        if code[0] in _NEXT[state]:
            out.append(("K", KEEP + extra, _NEXT[state][code[0]], True, ""))
        out += [("R", REROLE + extra, s, True, _ROLE[i]) for i, s in give]
    return out


def _to_go(codes: list[str], goals: tuple[int, ...], tail: bool) -> list[list[int]]:
    """[row][state] -> least cost from there to a goal state behind the last row."""
    end = [0 if s in goals else _FAR for s in _STATES]
    for _ in _STATES if tail else ():
        end = [min([end[s], *(c + end[t] for _, c, t, _, _ in _moves(None, s))]) for s in _STATES]
    out = [end]
    for code in reversed(codes):
        after, here = out[-1], [_FAR] * len(_STATES)
        for s in _STATES:
            here[s] = min([c + after[t] for _, c, t, used, _ in _moves(code, s) if used], default=_FAR)
        for _ in _STATES:  # insertions before the row
            here = [min([here[s], *(c + here[t] for _, c, t, used, _ in _moves(code, s) if not used)]) for s in _STATES]
        out.append(here)
    return out[::-1]


def search(codes: list[str], entry: int, goals: tuple[int, ...], tail: bool = True) -> tuple[int, str, int] | None:
    """(cost, edits, last state) of the best way from ``entry`` over all rows into one of ``goals``;
    None if there is none. ``tail`` allows insertions behind the last row."""
    bound = _to_go(codes, goals, tail)
    n, best = len(codes), None
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        at, state, cost, edits = stack.pop()
        total = cost + bound[at][state]
        if total >= _FAR or best and (total, edits) > best[:2]:
            continue
        known = seen.get((at, state))
        if known and known <= (cost, edits):
            continue
        seen[at, state] = (cost, edits)
        if at == n and state in goals and (best is None or (cost, edits) < best[:2]):
            best = (cost, edits, state)
        if at < n or tail:
            moves = _moves(codes[at] if at < n else None, state)
            children = [(at + used, s, cost + c, edits + e) for e, c, s, used, _ in moves]
            children.sort(key=lambda x: (x[2] + bound[x[0]][x[1]], x[3]), reverse=True)
            stack += children
    return best


def replay(codes: list[str], edits: str, entry: int) -> Iterator[tuple[int | None, str | None]]:
    """The rows that edits leave: (row, its new role or None), and (None, role) for insertions."""
    state, at = entry, 0
    for e in edits:
        code = codes[at] if at < len(codes) else None
        _, _, state_after, used, role = next(m for m in _moves(code, state) if m[0] == e)
        if e != "D":
            yield (at if used else None), (role or None)
        state, at = state_after, at + used


class _Solved(dict):
    """Searches done before by a task: most conversations are short, and their codes recur."""

    def search(self, codes: list[str], entry: int, goals: tuple[int, ...], tail: bool) -> tuple[int, str, int] | None:
        if len(codes) > REMEMBERED_ROWS:
            return search(codes, entry, goals, tail)
        key = (*codes, entry, goals, tail)
        if key not in self:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = search(codes, entry, goals, tail)
        return self[key]


class _Conversation:
    """One conversation, read row by row in order."""

    def __init__(self, conv_id, solved: _Solved):
        self.id, self.solved = conv_id, solved
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = self.last_turn = self.initial = None
        self.turns = 0
        # state -> (cost, edits, hash of the repaired text so far)
        self.ways = {_START: (0, "", None)}
        self._new_segment()

    def _new_segment(self) -> None:
        self.codes: list[str] = []
        self.rows: list[tuple[str, str]] = []
        self.chars = 0

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
        if self.initial is not None and self.initial + role[:1] not in _PAIRS:
            self.counts["illegal"] += 1
        self.initial = role[:1]
        if fault:
            self.counts[fault] += 1
        if len(self.codes) >= SEGMENT_ROWS or self.chars >= SEGMENT_CHARS:
            self._close(_STATES, False)
        self.codes.append("" if fault in ("blank", "duplicate") else (role[:1] or " ") + ("T" if fault else ""))
        self.rows.append((role, text))
        self.chars += len(text)

    def _close(self, goals, tail: bool) -> None:
        """Solve the segment from every state that can stand before it to every goal."""
        found = {}
        for entry, (cost, edits, digest) in self.ways.items():
            for goal in goals:
                piece = self.solved.search(self.codes, entry, (goal,), tail)
                if piece:
                    whole = (cost + piece[0], edits + piece[1])
                    if goal not in found or whole < found[goal][0]:
                        found[goal] = (whole, entry, piece[1], digest)
        self.ways = {g: (*whole, self._hashed(digest, entry, edits)) for g, (whole, entry, edits, digest) in found.items()}
        self._new_segment()

    def _hashed(self, before, entry: int, edits: str):
        digest = before and before.copy()
        for row, role in replay(self.codes, edits, entry):
            old_role, text = self.rows[row] if row is not None else ("", "")
            piece = f"{role or old_role}:{text}".encode()
            if digest is None:
                digest = hashlib.sha256(piece)
            else:
                digest.update(b"\n" + piece)
        return digest

    def result(self) -> tuple:
        self._close(_ACCEPT, True)
        cost, edits, digest = min(self.ways.values(), key=lambda w: w[:2])
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        sha = (digest or hashlib.sha256()).hexdigest()
        return self.id, gaps, *self.counts.values(), cost, edits, sha


def with_faults(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, digest, fault): each row's first fault, nulls as one space."""
    base = rows.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    return _faults(base, F.lit(True))


def _faults(base: DataFrame, present: Column) -> DataFrame:
    """Adds ``fault``; the one shuffle by conversation serves the window and the stream behind it."""
    trimmed = F.rtrim("text", F.lit(SPACE))
    same = Window.partitionBy("conv", "role", "digest", present).orderBy(F.col("turn").asc_nulls_first())
    fault = (
        F.when(~present, F.lit(None).cast("string"))
        .when(trimmed == "", "blank")
        .when(F.row_number().over(same) > 1, "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(*SENTENCE_END), "truncated")
    )
    return base.repartition("conv").withColumn("fault", fault)


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows of a test table, damaged by ``crc32("conv_id:turn") % 20``: 0 drops the row, 1 empties
    its text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user. A dropped row stays
    with ``present`` false, so that its conversation is not forgotten."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(word(conv_id), F.lit(":"), word(turn)).cast("binary")) % 20
    marked = rows.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), word(role).alias("role"), word(text).alias("text"), hit.alias("hit"))
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    new_text = F.when(F.col("hit").isin(0, 1), F.lit("")).when(F.col("hit") == 2, F.translate("text", "".join(SENTENCE_END), "")).otherwise(F.col("text"))
    return (
        marked.withColumn("copy", copies)
        .withColumns({"role": F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")), "text": new_text, "present": F.col("hit") != 0})
        .select("conv", "turn", "role", "text", "present", F.unhex(F.sha2("text", 256)).alias("digest"))
    )


def _repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``_faults`` rows, which stand together by conversation."""
    present = F.col("present") if "present" in rows.columns else F.lit(True)
    thin = rows.select("conv", F.col("turn").cast("long").alias("turn"), "role", "text", "fault", present.alias("present"), "digest")
    repeat = F.coalesce(F.col("fault") == "duplicate", F.lit(False))
    ordered = thin.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "digest", repeat).drop("digest")
    id_type = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {id_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_one, out, conv_type, solved = None, [], pa.null(), _Solved()

        def batch_of(results: list[tuple]) -> pa.RecordBatch:
            ids, *columns = zip(*results, strict=True)
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            arrays = [pa.array(ids, conv_type), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            conv_type = batch.column(0).type
            for at in range(0, batch.num_rows, SEGMENT_ROWS):
                part = batch.slice(at, SEGMENT_ROWS)
                for conv, turn, role, text, fault, here in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if open_one is None or conv != open_one.id:
                        if open_one:
                            out.append(open_one.result())
                        open_one = _Conversation(conv, solved)
                    if here:
                        open_one.add(turn, role, text, fault)
                if len(out) >= SEGMENT_ROWS:
                    yield batch_of(out)
                    out = []
        if open_one:
            out.append(open_one.result())
        if out:
            yield batch_of(out)

    return ordered.mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text) rows: conv, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256."""
    return _repair(with_faults(rows))


def repair_damaged(rows: DataFrame) -> DataFrame:
    """``repair`` of the rows after ``damage``."""
    return _repair(_faults(damage(rows), F.col("present")))


ship(__name__)
