"""Conversation repair, contextual personal data, embedding whitening."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from driftgate.llm import contextual_pii, turn_repair, whitening
from driftgate.llm.oracle_sql import pii_sql
from llm_fixtures import docs, no_docs, rows  # noqa: F401

SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, edits, repaired rows) of (role, text, fault) rows: every way in the order of cost, then edits."""
    heap, tick = [(0, "", 0, 0, (), "")], itertools.count(1)
    while heap:
        cost, edits, _, at, out, roles = heapq.heappop(heap)
        if at == len(rows) and (not roles or roles.endswith("a")):
            return cost, edits, out
        if roles.count("I") > len(rows) + 3:
            continue
        ways = []
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[roles[-1:]]
        for x, word in (("u", "user"), ("a", "assistant")):
            if x in after:
                ways.append((3, "I", at, (word, ""), x))
        if at < len(rows):
            role, text, fault = rows[at]
            ways.append((4, "D", at + 1, None, ""))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                if role[:1] and role[:1] in after:
                    ways.append((more, "K", at + 1, (role, text), role[:1]))
                ways += [(3 + more, "R", at + 1, (word, text), x) for x, word in (("u", "user"), ("a", "assistant")) if x in after]
        for c, e, to, row, x in ways:
            heapq.heappush(heap, (cost + c, edits + e, next(tick), to, (*out, row) if row else out, roles + x))


def brute_repair(table):
    """The contract's rows of (conv_id, turn, role, text) rows, in plain Python."""
    word = lambda v: " " if v is None else str(v)
    by_conv: dict = {}
    for conv, turn, role, text, *_ in table:
        kept = by_conv.setdefault(conv, [])
        hit = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = ("user" if hit == 4 else word(role)), ("" if hit == 1 else word(text))
        if hit == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        kept += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    out = []
    for conv, kept in by_conv.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faulty = set(), []
        for _, role, text in kept:
            end = text.rstrip(SPACE)
            faulty.append((role, text, "blank" if not end else "duplicate" if (role, text) in seen else None if end[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults = Counter(f for _, _, f in faulty)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        cost, edits, rows_ = cheapest(faulty)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows_).encode()).hexdigest()
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, edits, sha))
    return Counter(out)


def conversations():
    rnd = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "Trainer", "Dev"]
    texts = ["Yes.", "No!", "cut off", "", " \t\n", None, "Why? \n", "x" * 3000 + ".", "été 😀.", "Yes."]
    table = []
    for conv in [*range(60), None]:
        for turn in range(rnd.randint(1, 6)):
            role = rnd.choice(roles) if rnd.random() < 0.4 else ("user", "assistant")[turn % 2]
            table.append((conv, rnd.choice([turn, turn, turn, None, 2, turn * 3]), role, rnd.choice(texts) if rnd.random() < 0.5 else f"Answer {turn}.", "x", True))
            if rnd.random() < 0.2:
                table.append(table[-1])
    return table


CONV_SCHEMA = "conv_id long, turn long, role string, text string, fault string, present boolean"


@pytest.mark.parametrize("segment", [256, 1, 3])
def test_repair_against_every_way(spark, segment, monkeypatch):
    monkeypatch.setattr(turn_repair, "SEGMENT_ROWS", segment)
    table = conversations()
    got = turn_repair.repair_damaged(spark.createDataFrame(table, CONV_SCHEMA).repartition(5)).collect()
    assert Counter(tuple(r) for r in got) == brute_repair(table)


def test_search_from_and_to_every_state():
    rnd = random.Random(5)
    for _ in range(300):
        codes = [rnd.choice(["u", "a", "s", "uT", "aT", "", "x", " T", "sT", "D", "T"]) for _ in range(rnd.randint(0, 7))]
        for entry in range(4):
            whole = turn_repair.search(codes, entry, (0, 3))
            cut = rnd.randint(0, len(codes))
            joined = []
            for middle in range(4):
                a, b = turn_repair.search(codes[:cut], entry, (middle,), False), turn_repair.search(codes[cut:], middle, (0, 3))
                if a and b:
                    joined.append((a[0] + b[0], a[1] + b[1]))
            assert min(joined) == whole[:2]


def test_long_conversation_and_undamaged_rows(spark):
    turns = [(7, i, ("user", "assistant")[i % 2], f"Line {i}.") for i in range(3000)] + [(8, 0, "assistant", "Hello"), (9, 0, "system", "Be brief.")]
    got = {r.conv: r for r in turn_repair.repair(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    assert (got[7].cost, got[7].audit) == (0, "K" * 3000)
    assert got[7].repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in turns[:3000]).encode()).hexdigest()
    assert (got[8].cost, got[8].audit) == (4, "D")  # deleting beats an insertion and an unfinished end
    assert (got[9].cost, got[9].audit) == (4, "D")
    empty = spark.createDataFrame([], "conv_id string, turn long, role string, text string")
    assert turn_repair.repair_damaged(empty).collect() == []


PLANTED = [
    *[f"Text {i % 4}. Member number: {10 + i}.12.9.{i} was seen" for i in range(12)],
    "Some words. Member number: QX-99817-Z was seen again", "Here the member number: AB-55512 stays", "unrelated number 778899 in prose",
    "member number: 12 too short", "Write to a.b@example.org, c@d.e.f or x@y; +1 (017) 555-7713 and +12 or 4111 1111 1111 1111 or 4111111111111112",
    "1.2.3.4.5.6.7.8 300.1.1.1 0001.00.2.255 1..2.3.4.5", "@a.b .@x.y a@b.com.@x.y a@-.- é@a.b 漢字1.1.1.1字", "+1((((( +1 2 +123456789012345 +1234567890123456",
    "9" * 5000 + " " + "a" * 5000 + "@" + "b.c" * 5, "", None, " \n\t", "4012888888881881\n4012888888881881 4012-8888-8888-1881, 4012--888888881881",
]


@pytest.fixture(scope="module")
def personal(spark, tmp_path_factory):
    table = [(i, t, 1, 2, 3, "v") for i, t in enumerate(PLANTED)] + [(3, PLANTED[3], 1, 2, 3, "v"), (None, PLANTED[14], 1, 2, 3, "v")]
    path = str(tmp_path_factory.mktemp("pii") / "documents.parquet")
    spark.createDataFrame(table, "doc_id long, text string, row int, kind int, start int, value string").repartition(3).write.parquet(path)
    return path


def query_rows(found):
    counts = [f"n_{k}" for k in contextual_pii.KINDS]
    return Counter(tuple(r) for r in found.select("doc_id", *counts, F.sha2("base_spans", 256), "spans", "n_found").collect())


def test_pii_against_sql(spark, personal):
    found = contextual_pii.find(spark.read.parquet(personal))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{personal}/*.parquet')")
    assert query_rows(found) == Counter(con.execute(pii_sql()).fetchall())


def test_pii_finds_unseen_identifiers(spark, personal):
    found = {r.doc_id: r for r in contextual_pii.find(spark.read.parquet(personal)).filter("doc_id > 3").collect()}
    assert [found[i].n_found for i in (12, 13, 14, 15)] == [1, 1, 0, 0]
    assert found[12].spans == "ip:27:37" and PLANTED[12][27:37] == "QX-99817-Z"
    assert found[12].base_spans == "" and found[12].n_ip == 0
    assert found[16].n_email == 2 and found[16].n_phone == 1 and found[16].n_card == 1


def test_pii_on_the_fixture_and_without_rows(docs, no_docs, rows):  # noqa: F811
    found = contextual_pii.find(docs)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found.collect()) == sorted((r[0] is None, r[0] or 0) for r in rows)
    assert contextual_pii.find(no_docs).collect() == []


def vectors():
    rnd = np.random.default_rng(11)
    base = rnd.normal(size=(200, 6)) @ rnd.normal(size=(6, 6))
    table = [(int(i), [float(c) for c in v], 1, "z") for i, v in enumerate(base)]
    table += [(500 + i, table[0][1], 1, "z") for i in range(150)]  # a hot vector
    table += [(1, table[1][1], 1, "z"), (None, table[2][1], 1, "z"), (900, None, 1, "z"), (901, [], 1, "z"), (902, [1.0, None, 2.0, 3.0, 4.0, 5.0], 1, "z")]
    table += [(903, [float("nan")] + [1.0] * 5, 1, "z"), (904, [float("-inf")] + [1.0] * 5, 1, "z"), (905, [1.0, 2.0], 1, "z"), (906, [-0.001] * 6, 1, "z")]
    return table


VEC_SCHEMA = "vec_id long, embedding array<double>, x int, rows string"


@pytest.mark.parametrize("weight", ["one", "count"])
def test_whitening_against_numpy(spark, weight):
    table = [r for r in vectors() if r[1] and len(r[1]) == 6 and all(c is not None and np.isfinite(c) for c in r[1])]
    x = np.array([[int(np.floor(256 * c)) for c in v] for _, v, *_ in table])
    fit, counts = np.unique(x, axis=0, return_counts=True)
    if weight == "count":
        fit = np.repeat(fit, counts, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    got = whitening.whiten(spark.createDataFrame(vectors(), VEC_SCHEMA).repartition(4), weight=weight).collect()
    assert len(got) == 4 * len(table)
    assert Counter(r.vec_id for r in got if r.component == 1) == Counter(r[0] for r in table)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    deviations = Counter((r[0], int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums, strict=True)))) for r, v in zip(table, x, strict=True))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == deviations
    for k in range(4):
        want = {r[0]: z for r, z in zip(table, (x - sums / n) @ axes[:, k] / np.sqrt(values[k]), strict=True)}
        have = {r.vec_id: r.whitened for r in got if r.component == k + 1}
        sign = np.sign(want[5] * have[5])
        assert all(abs(sign * have[i] - want[i]) < 1e-9 for i in want)
        assert all(abs(r.explained - values[k] / values.sum()) < 1e-12 for r in got if r.component == k + 1)


def test_whitening_without_variance_or_rows(spark):
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r.whitened, r.explained, r.deviation, r.identity_error) for r in same] == [(0.0, 0.0, 0, 0.0)] * 4
    none = whitening.whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>"))
    assert none.collect() == [] and none.columns[0] == "vec_id"
    huge = whitening.whiten(spark.createDataFrame([(i, [1e300, float(i)]) for i in range(3)], "vec_id long, embedding array<double>")).collect()
    assert len(huge) == 6
