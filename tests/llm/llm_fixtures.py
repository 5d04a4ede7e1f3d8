"""A small fixture table with what the contracts name: nulls, empty and very long texts, ties,
repeated rows and further columns with clashing names."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, block int, words string, host string, section int, n_words int"
BENCH = [
    (0, "Alpha beta GAMMA delta epsilon zeta eta theta iota kappa lambda mu nu"), (1, "one two"), (2, None), (3, ""),
    (4, "Alpha beta gamma delta epsilon zeta eta theta iota kappa"), (None, "xi omicron pi rho sigma tau upsilon phi chi psi omega"),
]


def texts() -> list[str | None]:
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("abcdeéstn") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage, long = prose(60), prose(6000)
    lines = lambda *x: "\n".join(x)
    out: list[str | None] = [None, "", " \t\n ", "word", "one two", "x\x1cy  z  \n\n q ", long, long, long + " tail"]
    out += [lines(prose(30), passage, prose(20)) for _ in range(4)]
    out += [f"{prose(10)} alpha BETA gamma, delta epsilon zeta eta theta iota kappa lambda {prose(5)}", f"{prose(30)} one two {prose(3)}"]
    out += [lines(prose(25), "Cookie notice: we use cookies", prose(25)) for _ in range(14)]
    out += ["the same words again and again " * 30, "***  ### $$$ " * 12, "a" * 300 + " " + "漢字" * 50 + "😀 end"]
    out += [prose(40)] * 3 + [prose(45)]
    return out


@pytest.fixture(scope="session")
def rows():
    out = [(i, t, "en", "s1" if i % 3 else "s0", len(t or ""), 5, 6, "w", "h", 1, 2) for i, t in enumerate(texts())]
    out.append(out[7])  # a repeated row
    out.append((None, "a text without an id " * 4, None, None, None, None, None, None, None, None, None))
    out.append((None, None, None, None, None, None, None, None, None, None, None))
    return out


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.filter(F.lit(False))


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


@pytest.fixture(scope="session")
def labels(spark, rows):
    return spark.createDataFrame([(i, 0 if i % 4 == 0 else 1, 0) for i in range(0, 30)] + [(None, 0, 1), (4, None, None)], "doc_id long, quality int, toxic int")
