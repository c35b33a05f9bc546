"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunksink.llm import bpe, decontaminate, html_text, line_dedup, quality_rules, repeats, simhash, simple8b, toxicity
from chunksink.llm.scratch import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.drop_seen_passages(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "n_spans")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("n_shared").cast("long").alias("n_shared"), F.col("n_shingles").cast("long").alias("n_shingles"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_stop_words", "n_lines")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, toxicity.training_labels(_table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, model).select("doc_id", "score")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_token_ids(spark: SparkSession, sf_dir: str, vocabulary: str = public_tokenizers.path("word_bpe_49k.json")) -> DataFrame:
    folder = shared_dir(spark, "token-ids")
    simple8b.write_ids(_table(spark, sf_dir, "documents"), folder, vocabulary, end_id=1)
    ids = F.col("ids")
    return simple8b.read_ids(spark, folder).select("doc_id", "start", (F.octet_length(ids) / 4).cast("long").alias("n_tokens"), F.crc32(ids).alias("ids_crc32"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.link_documents(_table(spark, sf_dir, "documents"))
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = public_tokenizers.path("byte_bpe_50k.json")) -> DataFrame:
    return bpe_digest(_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)


def bpe_digest(docs: DataFrame, vocabulary: str = public_tokenizers.path("byte_bpe_50k.json")) -> DataFrame:
    coded = bpe.encode(docs.select("doc_id", "text"), vocabulary, decoded="decoded")
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.drop_repeated_bytes(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_token_ids": op6_token_ids,
    "op7_html_text": op7_html_text,
    "op8_simhash": op8_simhash,
    "op9_bpe": op9_bpe,
    "op10_suffix_array": op10_suffix_array,
}

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))

ORACLES: dict[str, str] = {
    "op3_decontaminate": r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT 'b', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM benchmark WHERE item_id IS NOT NULL
), places AS (SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5),
shingles AS (SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS s FROM places),
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared, max(z.n) AS n_shingles
FROM shingles b JOIN shingles d ON b.kind = 'b' AND d.kind = 'd' AND b.s = d.s JOIN sizes z ON z.id = b.id
GROUP BY d.id, b.id HAVING count(*) >= 0.8 * max(z.n)""",
    "op4_quality_rules": rf"""
WITH base AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), places AS (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM base WHERE len(w) >= 8),
windows AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s FROM places),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words, len(ls) AS n_lines,
         len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS bullets,
         len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS ellipses
  FROM base LEFT JOIN covered USING (r)
), j AS (SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed, greatest(n_words, 1)::DOUBLE AS pw, greatest(n_lines, 1)::DOUBLE AS pl FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / pw BETWEEN 2.0 AND 14.0 AND n_symbols / pw <= 0.1 AND n_stop_words / pw >= 0.05
       AND n_dup_lines / pl <= 0.4 AND bullets / pl <= 0.9 AND ellipses / pl <= 0.3 AS kept,
       n_stop_words, n_lines
FROM j""",
}
