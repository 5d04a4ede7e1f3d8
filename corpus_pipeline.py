"""The training-data pipeline over ``documents``: five stages, each one of the operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's
result as Parquet in the shared folder and gives the reread table to the next. All but the last
return the columns of ``documents``. What a stage drops:

1. quality rules: documents that the base rule or the learned decision list rejects;
2. line dedup: boilerplate lines of a source, pages with equal lines counted once, since copies
   go only in the next stage (the text changes, documents stay; ``n_chars``, if there is one, is
   recounted for changed texts);
3. SimHash near-dedup: all but the smallest id of each group;
4. benchmark decontamination: documents with an occurrence of a benchmark window;
5. SentencePiece: nothing; each document's ids, their number, and whether they decode to its text.

Nulls, empty texts, repeated rows, empty tables and further columns: as each operator states.
A document whose lines were all boilerplate stays with an empty text until near-dedup, which
keeps one of those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.llm import decision_list, decontaminate, piece_lattice, simhash_ring, site_lines
from driftgate.llm.common import read
from driftgate.llm.queries import tokenizer
from driftgate.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decision_list.keep_good(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    if "n_chars" not in docs.columns:
        return site_lines.drop_boilerplate(docs, "source", "text", once=True)
    out = site_lines.drop_boilerplate(docs, "source", "text", once=True, dropped_col="__dg_dropped")
    n_chars = F.when(F.col("__dg_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_ring.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = piece_lattice.load(tokenizer("piece_bpe_32k.model"))
    return piece_lattice.encode(docs, model, results=("ids", "n_ids", "round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: The learned list, XXH64 and the encoder are not SQL; tests hold every stage's rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage_" + name.split()[0].lower())
    return docs
