"""The registered queries of the operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftgate.llm import (
    contextual_pii,
    decision_list,
    decontaminate,
    host_reputation,
    nested_secrets,
    oracle_sql as long_sql,
    phrase_automata,
    piece_lattice,
    simhash_ring,
    site_lines,
    token_attribution,
    token_frames,
    turn_repair,
    whitening,
)
from driftgate.llm.common import read
from driftgate.session import scratch_path


def tokenizer(name: str) -> str:
    """The default place of the public vocabulary files; every operator takes a path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_attribution.attribute(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nested_secrets.find(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_layers", "deepest", "n_cut_layers"
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token_files")
    manifest = token_frames.write(read(spark, sf_dir, "documents"), folder, tokenizer("byte_bpe_50k.json"))
    return token_frames.checksums(token_frames.read(spark, manifest))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_automata.dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_lattice.load(tokenizer("piece_bpe_32k.model"))
    return piece_lattice.encode(read(spark, sf_dir, "documents"), model, results=("n_ids", "ids_crc32", "decoded_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = site_lines.drop_boilerplate(docs, "source", "text", lines_col="n_lines", dropped_col="n_dropped")
    return out.select("doc_id", "source", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes are the given labels of the page's record id: bad if of low quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    outcomes = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return host_reputation.judge(read(spark, sf_dir, "pages"), outcomes).select("page_id", "host", "path", "rule", "verdict", "host_labels", "bad_rate_bound")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ring.near_duplicates(read(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_damaged(read(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contextual_pii.find(read(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in contextual_pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_found")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


SQL = {}

SQL["op4_substring_dedup"] = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
owned AS (SELECT t, min(doc_id) AS owner FROM win GROUP BY t),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS k FROM win JOIN owned USING (t) WHERE owner < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS k FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS text
  FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

SQL["op6_line_dedup"] = f"""
WITH l AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS worded
  FROM documents),
pages AS (SELECT source, worded FROM l WHERE text IS NOT NULL),
totals AS (SELECT source, count(*) AS n_pages FROM pages GROUP BY source),
counted AS (
  SELECT source, line, count(*) AS n FROM (SELECT source, unnest(list_distinct(worded)) AS line FROM pages)
  GROUP BY source, line HAVING count(*) > 1),
shares AS (
  SELECT c.source, c.line, t.n_pages::DOUBLE - 1.0::DOUBLE AS n, (c.n::DOUBLE - 1.0::DOUBLE) / (t.n_pages::DOUBLE - 1.0::DOUBLE) AS p, {site_lines.Z * site_lines.Z}::DOUBLE AS zz
  FROM counted c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source),
over AS (
  SELECT source, list(line) AS dropped FROM shares
  WHERE (p + zz / (n * 2.0::DOUBLE) - sqrt(p * (1.0::DOUBLE - p) / n + zz / (n * n * 4.0::DOUBLE)) * {site_lines.Z}::DOUBLE) / (zz / n + 1.0::DOUBLE) > {site_lines.RATIO}::DOUBLE
  GROUP BY source),
kept AS (
  SELECT l.doc_id, l.source, l.lines, list_filter(l.lines, lambda x: NOT list_contains(coalesce(o.dropped, []), x)) AS kept
  FROM l LEFT JOIN over o ON l.source IS NOT DISTINCT FROM o.source)
SELECT doc_id, source, coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(kept), 0) AS n_dropped,
       sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256
FROM kept
"""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL["op10_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_BENCH_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_BENCH_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), {decontaminate.WINDOW_WORDS}) AS n,
         array_to_string(w[i:i + least(len(w), {decontaminate.WINDOW_WORDS}) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - {decontaminate.WINDOW_WORDS - 1}))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
places AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n),
found AS (
  SELECT p.doc_id, p.i, p.n, bw.item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM places) p JOIN bw ON bw.win = p.win AND bw.n = p.n),
hit AS (SELECT doc_id, count(DISTINCT word_no) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS word_no FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hit.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SQL["op8_url_filters"] = long_sql.url_sql()
SQL["op11_conversation_repair"] = long_sql.CONVERSATION_REPAIR
SQL["op12_pii"] = long_sql.pii_sql()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_secret_scans": op2_secret_scans,
    "op3_token_files": op3_token_files,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filters": op8_url_filters,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_pii": op12_pii,
    "op13_whitening": op13_whitening,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
