"""Operators that compare documents, rows of a host, or labels, and the pipeline."""

from __future__ import annotations

import hashlib
import os
import random
import re
import sys
import unicodedata
from collections import Counter

import duckdb
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from driftgate.llm import decision_list, decontaminate, host_reputation, phrase_automata, simhash_ring, site_lines
from driftgate.llm.queries import QUERIES, SQL, tokenizer
from driftgate.operators import identity
from llm_fixtures import BENCH, SCHEMA, benchmark, docs, labels, no_docs, rows  # noqa: F401
from oracle_compare import compare, duck

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF_SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    ok, message, _ = compare(spark, duck(SF_SMALL), name, QUERIES[name], SQL[name], SF_SMALL)
    assert ok, message


def brute_dedup(rows, n=13):
    owner = {}
    for doc_id, text, *_ in rows:
        w = WORDS.findall(text or "")
        for i in range(len(w) - n + 1):
            if doc_id is not None:
                k = tuple(w[i : i + n])
                owner[k] = min(owner.get(k, doc_id), doc_id)
    out = Counter()
    for doc_id, text, *_ in rows:
        w = WORDS.findall(text or "")
        gone = {j for i in range(len(w) - n + 1) if doc_id is not None and owner[tuple(w[i : i + n])] < doc_id for j in range(i, i + n)}
        out[doc_id, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)] += 1
    return out


@pytest.mark.parametrize("block_chars", [10**9, 30_000, 2_000])
def test_substring_dedup(docs, rows, no_docs, block_chars, monkeypatch):
    monkeypatch.setattr(phrase_automata, "SHARD_CHARS", 500)
    got = Counter(tuple(r) for r in phrase_automata.dedup(docs, block_chars=block_chars).collect())
    assert got == brute_dedup(rows)
    assert phrase_automata.dedup(no_docs).count() == 0


def test_substring_dedup_of_rows_with_equal_ids(spark):
    """Different texts under one id stand in the same order whenever a block is read."""
    rnd = random.Random(3)
    passages = [" ".join(f"w{rnd.randint(0, 500)}" for _ in range(30)) for _ in range(12)]
    table = [(rnd.randint(0, 15), " ".join(f"u{rnd.randint(0, 900)}" for _ in range(rnd.randint(0, 20))) + " " + rnd.choice(passages) + " end") for _ in range(80)]
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(7)
    for block_chars in (10**9, 1500, 200):
        assert Counter(tuple(r) for r in phrase_automata.dedup(df, block_chars=block_chars).collect()) == brute_dedup(table)


def brute_print(text):
    w = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(x >> j & 1 for x in h) > len(h)) << j for j in range(64)) if h else 0


def brute_components(prints):
    ids = [(i, p) for i, p in prints]
    group = list(range(len(ids)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (ids[a][1] ^ ids[b][1]).bit_count() <= 3:
                group[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(ids):
        if i is not None:
            low[root(k)] = min(low.get(root(k), i), i)
    return Counter((i, f"{p:016x}", low.get(root(k))) for k, (i, p) in enumerate(ids))


def test_simhash_on_edge_cases(docs, rows, no_docs):
    want = brute_components([(r[0], brute_print(r[1])) for r in rows])
    assert Counter(tuple(r) for r in simhash_ring.near_duplicates(docs).collect()) == want
    assert simhash_ring.near_duplicates(no_docs).count() == 0 and simhash_ring.one_of_each(no_docs).count() == 0
    kept = simhash_ring.one_of_each(docs)
    assert sorted(map(str, kept.collect())) == sorted(map(str, simhash_ring.one_of_each(identity.identified(docs)).collect()))
    assert kept.columns == docs.columns
    groups = {(c if c is not None else p) for _, p, c in want}
    assert kept.count() == len(groups) and {r.doc_id for r in kept.collect()} - {None} == {c for _, _, c in want if c is not None}


def test_simhash_query_whole_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op9_simhash_near_dedup"](spark, SF_SMALL).collect())
    assert got == brute_components([(r.doc_id, brute_print(r.text)) for r in rows])


def test_ring_links_lose_nothing(spark):
    import random

    rnd = random.Random(11)
    prints = set()
    for _ in range(60):
        x = rnd.getrandbits(64)
        prints |= {x ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for _ in range(8)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for bits in (0, 1, 2, 3):
        want = {tuple(sorted((signed(a), signed(b)))) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= bits}
        df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
        assert {tuple(r) for r in simhash_ring.candidate_links(df, bits).collect()} == want


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)]
    got = {r.node: r.root for r in simhash_ring.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 100 for i in range(100, 140)}}


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def test_decontamination_edge_cases(docs, rows, no_docs, benchmark):
    items = [(i, bench_words(t)) for i, t in benchmark.collect()]
    want = Counter()
    for doc_id, text, *_ in rows:
        w = bench_words(text)
        hit, found = set(), set()
        for item, b in items:
            n = min(10, len(b))
            windows = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if b else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= {str(item)} if item is not None else set()
        want[doc_id, len(w), len(hit), tuple(sorted(found))] += 1
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in decontaminate.contamination(docs, benchmark).collect())
    assert got == want and any(k[2] for k in want)
    assert decontaminate.contamination(no_docs, benchmark).count() == 0
    assert decontaminate.contamination(docs, benchmark.limit(0)).filter("n_hit > 0").count() == 0
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if not k[2])


def brute_boilerplate(table, once=False):
    """Whether a line of a host is boilerplate, of (host, text) rows."""
    worded = lambda t: [x for x in t.split("\n") if WORDS.search(x)]
    pages = [(h, tuple(worded(t))) for h, t in table if t is not None]
    pages = list(set(pages)) if once else pages
    totals, counts = Counter(h for h, _ in pages), Counter((h, x) for h, lines in pages for x in set(lines))

    def boilerplate(host, line):
        n, k, z = totals[host] - 1, counts[host, line] - 1, 1.96
        if k < 1:
            return False
        p = k / n
        return (p + z * z / (2 * n) - z * (p * (1 - p) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n) > 0.065

    return boilerplate


def brute_lines(table, once=False):
    """(host, text without boilerplate, dropped lines) of (host, text) rows."""
    boilerplate, out = brute_boilerplate(table, once), Counter()
    for host, t in table:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not WORDS.search(x) or not boilerplate(host, x)]
        out[host, None if t is None else "\n".join(kept), len(lines) - len(kept)] += 1
    return out


@pytest.mark.parametrize("limit", [10**6, 0])
@pytest.mark.parametrize("once", [False, True])
def test_line_dedup(docs, rows, no_docs, once, limit, monkeypatch):
    monkeypatch.setattr(site_lines, "BROADCAST_LINES", limit)
    want = brute_lines([(r[3], r[1]) for r in rows], once)
    out = site_lines.drop_boilerplate(docs, once=once, lines_col="n", dropped_col="gone").collect()
    assert Counter((r.source, r.text, r.gone) for r in out) == want and any(k[2] for k in want)
    assert not any("Cookie" in (r.text or "") for r in out)
    assert site_lines.drop_boilerplate(docs).columns == docs.columns and site_lines.drop_boilerplate(no_docs).count() == 0


def test_line_dedup_treats_hosts_of_any_size_alike(spark):
    shares = {"large": (2000, 700), "hot": (20_000, 10_000), "under": (2000, 100), "small": (12, 12), "tiny": (9, 9), "pair": (2, 2), "one": (1, 1), "few": (10, 2)}
    table = [(host, f"own line {i} of {host}" + ("\nfooter" if i < n else "")) for host, (pages, n) in shares.items() for i in range(pages)]
    df = spark.createDataFrame(table, "source string, text string")
    out = site_lines.drop_boilerplate(df, dropped_col="gone")
    assert Counter((r.source, r.text, r.gone) for r in out.collect()) == brute_lines(table)
    kept = {r.source for r in out.filter(F.col("text").contains("footer")).select("source").distinct().collect()}
    assert kept == {"under", "one", "few"}


def test_copies_are_not_boilerplate_if_they_count_once(spark):
    table = [("h", "the same page\nof a group of copies")] * 60 + [("h", f"own page {i}") for i in range(30)]
    df = spark.createDataFrame(table, "source string, text string")
    gone = lambda **how: site_lines.drop_boilerplate(df, dropped_col="gone", **how).agg(F.sum("gone")).first()[0]
    assert gone(once=True) == 0 and gone() == 120


def brute_stats(text):
    w = WORDS.findall(text or "")
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeated = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    n, r = len(w), len(repeated)
    return (n, sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n)


def test_quality_statistics(docs, rows, no_docs, labels):
    got = Counter((r.doc_id, *r[1:7]) for r in decision_list.judge(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
    assert got == Counter((r[0], *brute_stats(r[1])) for r in rows)
    assert decision_list.judge(no_docs, labels).count() == 0
    none = decision_list.judge(docs, labels.limit(0))
    assert none.filter("kept = base_failed").count() == 0
    kept = decision_list.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in decision_list.judge(docs, labels).filter("kept").collect())


def test_quality_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: brute_stats(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op7_quality_rules"](spark, sf)
    for r in out.collect():
        assert tuple(r[1:7]) == rows[r.doc_id] and not (r.kept and r.base_failed)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    half = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == k
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = decision_list.judge(docs, labels.filter(half(0))).join(labels.filter(half(1)), "doc_id").filter("not base_failed")
    right = held.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double")).alias("a")).first().a
    assert right > 0.95


def test_a_list_of_two_rules_is_learned(spark):
    stats = [(i, 100, 400 + i % 50, 60 if i % 10 == 0 else 0, 0, 0, 20, 80, 90 if i % 10 == 5 else 3, 0, 0) for i in range(1000)]
    df = spark.createDataFrame(stats, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_distinct_words long, n_upper long, n_digits long, n_marks long")
    labels = spark.createDataFrame([(i, 0 if i % 5 == 0 else 1) for i in range(1000)], "doc_id long, quality int")
    rules = decision_list.learn(df, labels)
    assert {c.feature for r in rules for c in r.conditions} == {"symbols per word", "capitals per character"}
    wrong = df.withColumn("r", decision_list.rejected_by(rules)).filter((F.col("doc_id") % 5 == 0) != F.col("r").isNotNull())
    assert wrong.count() == 0


def test_url_filters(spark):
    urls = [
        (0, "HTTP://WWW.Example.COM/en/x?q"), (1, "http://a.example.com/en/x"), (2, "https://x.net/es/"), (3, "https://x.net/esx"), (4, None), (5, "nothing"),
        (6, "http://bad.org/1"), (7, "http://bad.org/2"), (8, "http://sub.bad.org"), (9, "http://good.org/#a"), (10, "http://netx.org/fr/"), (9, "http://good.org/#a"),
    ] + [(100 + i, f"http://bad.org/{i}") for i in range(40)] + [(200 + i, f"http://good.org/{i}") for i in range(60)]
    pages = spark.createDataFrame([(*u, "x") for u in urls], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(100 + i, 1) for i in range(40)] + [(200 + i, 0) for i in range(60)] + [(9, None)], "page_id long, bad int")
    out = {r.page_id: r for r in host_reputation.judge(pages, outcomes).collect()}
    assert host_reputation.judge(pages, outcomes).count() == len(urls)
    assert [(out[i].host, out[i].path, out[i].rule, out[i].verdict) for i in range(6)] == [
        ("www.example.com", "/en/x", "www.example.com/en/", "allow"), ("a.example.com", "/en/x", "example.com/en/", "block"),
        ("x.net", "/es/", "net/es/", "block"), ("x.net", "/esx", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
    ]
    assert out[6].verdict == "block" and out[9].verdict == "allow" and out[10].rule is None
    assert out[9].bad_rate_bound < out[8].bad_rate_bound < out[6].bad_rate_bound
    assert host_reputation.judge(pages, outcomes.limit(0)).filter("rule is null and verdict <> 'allow'").count() == 0
    assert host_reputation.judge(pages.limit(0), outcomes).count() == 0


def test_host_levels(spark):
    want = {
        "a.b.co.uk:80": ("b.co.uk", "co.uk"), "x.example.com": ("example.com", "com"), "localhost": ("localhost", "localhost"), "": ("", ""),
        "10.0.0.1": ("10.0.0.1", "[ip]"), "10.0.0.1:8080": ("10.0.0.1", "[ip]"), "[2001:db8::1]:80": ("[2001:db8::1]", "[ip]"), "1.2.3.4.com": ("4.com", "com"),
        "a.x.github.io": ("x.github.io", "github.io"), "github.io": ("github.io", "github.io"), "notgithub.io": ("notgithub.io", "io"),
        "b.a.or.jp": ("a.or.jp", "or.jp"), "co.uk": ("co.uk", "uk"), "www.example.com.": ("example.com", "com"), "example.com..:80": ("example.com", "com"),
        "me:pw@example.com": ("example.com", "com"), "...": ("", ""),
    }
    df = spark.createDataFrame([(h,) for h in want], "h string")
    assert {r.h: (r.d, r.s) for r in df.select("h", *[c.alias(n) for c, n in zip(host_reputation.levels(F.col("h")), "ds", strict=True)]).collect()} == want
    own = host_reputation.levels(F.lit("a.b.c.d.example"), ("c.d.example", "d.example", "b.c.d.example"))
    assert tuple(df.select(*own).first()) == ("a.b.c.d.example", "b.c.d.example")


def test_host_reputation_matches_sql_on_planted_hosts(spark, tmp_path):
    hosts = [
        ("spam.github.io", 60, 58), ("a.spam.github.io", 4, 4), ("fine.github.io", 60, 1), ("10.0.0.1:80", 50, 49), ("10.0.0.2", 50, 0), ("X.Bad.or.jp.", 30, 29),
        ("www.bad.or.jp", 3, 0), ("good.co.uk", 80, 4), ("[::1]:80", 2, 1), ("u:p@bad.org", 40, 38), ("bad.org", 7, 7), ("localhost", 5, 1), ("", 3, 3), ("...", 2, 0), ("github.io", 3, 1),
    ]
    rows = [(f"http://{h}/p{i}", int(i < bad)) for h, n, bad in hosts for i in range(n)]
    rows += [(None, 1), ("no host", 0), ("http://sub.spam.github.io/unlabelled", None), ("http://bad.org", None), ("http://x.net/es/", None), ("http://www.example.com/en/?q", 1), ("https://example.com#/en/", 0)]
    pages = [(i, u, "x") for i, (u, _) in enumerate(rows)]
    spark.createDataFrame(pages + pages[:3], "page_id long, url string, bound string").write.parquet(f"{tmp_path}/pages.parquet")
    labels = [(i, None if b is None else 1 - b, 0, "x") for i, (_, b) in enumerate(rows)] + [(4, 1, 1, "y"), (None, 0, 0, "z"), (5, None, 1, "w")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, bad string").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    ok, message, _ = compare(spark, con, "op8_url_filters", QUERIES["op8_url_filters"], SQL["op8_url_filters"], str(tmp_path))
    assert ok, message
    blocked = {r.host for r in QUERIES["op8_url_filters"](spark, str(tmp_path)).filter("rule is null and verdict = 'block'").collect()}
    assert {"spam.github.io", "sub.spam.github.io", "10.0.0.1:80", "u:p@bad.org"} <= blocked
    assert not blocked & {"fine.github.io", "10.0.0.2", "good.co.uk", "localhost", "github.io"}


def test_host_reputation_relative_to_the_corpus(spark):
    hosts = [("bad.org", 200, 80)] + [(f"h{i}.org", 200, 10) for i in range(9)]
    rows = [(f"{h}-{i}", f"http://{h}/p{i}", int(i < bad)) for h, n, bad in hosts for i in range(n)]
    df = spark.createDataFrame(rows, "page_id string, url string, bad int")
    blocked = lambda **how: {r.host for r in host_reputation.judge(df, df.select("page_id", "bad"), rules=(), **how).filter("verdict = 'block'").collect()}
    assert blocked() == set()  # 0.4 is under the absolute threshold
    assert blocked(times_corpus=2.0) == {"bad.org"} and blocked(times_corpus=8.0) == set()


def test_pipeline_stages(spark, docs, rows, benchmark, labels, tmp_path):
    import corpus_pipeline as C

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in C.STAGES][0] == "quality rules" and len(C.STAGES) == 5
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sizes = [at.count()]
    for i, (_, stage) in enumerate(C.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/out{i}")
        at = spark.read.parquet(f"{tmp_path}/out{i}")
        sizes.append(at.count())
        assert i == 4 or at.columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    judged = decision_list.judge(docs, labels).filter("kept").select("doc_id")
    assert sizes[1] == sizes[2] == judged.count()
    kept = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/out2").collect()}
    assert kept <= {r.doc_id for r in judged.collect()} and sizes[3] < sizes[2]
    assert at.filter("not round_trip").count() == 0 and sizes[5] == sizes[4]
    assert sorted(r.doc_id for r in C.run(spark, str(tmp_path)).collect()) == sorted(r.doc_id for r in at.collect())


def brute_features(text):
    t = text or ""
    w, lines = WORDS.findall(t), [x for x in t.split("\n") if WORDS.search(x)]
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, _ = brute_stats(t)
    upper = sum(unicodedata.category(c) == "Lu" for c in t)
    counts = dict(
        n_words=n_words, word_chars=word_chars, n_symbols=n_symbols, n_dup_lines=n_dup_lines, n_repeat_words=n_repeat_words, n_lines=len(lines),
        n_distinct_words=len(set(w)), n_upper=upper, n_digits=sum(c in "0123456789" for c in t), n_marks=t.count("!") + t.count("?"),
    )
    return {name: counts[a] / counts[b] if counts[b] else 0.0 for name, (a, b) in decision_list.FEATURES.items()}


def test_pipeline_against_brute_force(spark, rows, tmp_path):
    """All five stages in plain Python; of the operators only the learned rules are taken, and judged here."""
    import corpus_pipeline as C

    rnd = random.Random(5)
    words = ["".join(rnd.choice("aeioubcdfg") for _ in range(rnd.randint(3, 9))) for _ in range(900)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    page = prose(300)
    texts = [prose(40) + " ### $$$ <> ** " * 6 + prose(20) for _ in range(45)] + [prose(60) for _ in range(60)]
    texts += [f"{prose(30)}\nAll rights reserved, foot of the site\n{prose(30)}" for _ in range(25)]
    texts += [page, page, page.replace(" ", "  "), f"{page} {prose(1)}", page + "\nAll rights reserved, foot of the site"]
    texts += [f"{prose(20)} {item} {prose(25)}" for _, item in BENCH if item and len(item) > 9] + [f"{prose(30)}\n" * 3]
    more = [(100 + i, t, "en", f"h{i % 3}", len(t), 5, 6, "w", "h", 1, 2) for i, t in enumerate(texts)]
    table = rows + more
    labels = [(i, 1, 0) for i in range(0, 30)] + [(r[0], int("###" not in r[1]), 0) for r in more] + [(None, 0, 1), (4, None, None)]
    docs = spark.createDataFrame(table, SCHEMA).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rules = decision_list.learn(decision_list.with_statistics(at.select("doc_id", "text")), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert rules

    def rejected(text):
        f = brute_features(text)
        return any(all((f[c.feature] >= c.threshold) == c.at_least for c in rule.conditions) for rule in rules)

    good = [r for r in table if not brute_stats(r[1])[-1] and not rejected(r[1])]
    boilerplate, deduped = brute_boilerplate([(r[3], r[1]) for r in good], once=True), []
    for r in good:
        text = "\n".join(x for x in r[1].split("\n") if not WORDS.search(x) or not boilerplate(r[3], x))
        deduped.append((r[0], text, *r[2:4], r[4] if text == r[1] else len(text), *r[5:]))
    assert deduped != good
    groups = brute_components([(k, brute_print(r[1])) for k, r in enumerate(deduped)])
    members = {}
    for k, _, low in groups:
        members.setdefault(low, []).append(deduped[k])
    unique = [min(m, key=lambda r: (r[0] is None, r[0])) for m in members.values()]
    windows = set()
    for _, item in BENCH:
        b = bench_words(item)
        windows |= {tuple(b[i : i + min(10, len(b))]) for i in range(max(1, len(b) - 9))} if b else set()

    def clean(text):
        w = bench_words(text)
        return not any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))

    last = [r for r in unique if clean(r[1])]
    assert len(table) > len(good) > len(unique) > len(last) > 50
    for i, (_, stage) in enumerate(C.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/stage{i}")
        at = spark.read.parquet(f"{tmp_path}/stage{i}")
        if i < 4:
            assert Counter(map(tuple, at.collect())) == Counter((good, deduped, unique, last)[i]), C.STAGES[i][0]
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    want = Counter()
    for r in last:
        ids = tuple(sp.encode(r[1]))
        want[r[0], ids, len(ids), True] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.n_ids, r.round_trip) for r in C.run(spark, str(tmp_path)).collect()) == want
