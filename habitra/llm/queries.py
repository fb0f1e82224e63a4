"""Queries of the operators over their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from habitra.llm import bpe, html_extract, merkle, packing, quality_fm, quality_rules, simhash, suffix_dedup, token_counts, tokenbin
from habitra.llm.common import table

BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files lie; driver and executors have them in the same place."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(BYTE_BPE)
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return decoded.select("doc_id", F.expr("CAST(length(ids) / 4 AS BIGINT)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op2_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.compare_edited(merkle.with_next(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_tokenbin(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = tokenbin.write(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE), end_id=2)
    return tokenbin.read(blocks).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(simhash.fingerprints(table(spark, sf_dir, "documents"), shingle=3), bits=64, width=32, radius=1, most=2)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), tokenizer_path(PIECE_BPE)
    return token_counts.token_counts(docs, path, token_counts.fit(docs, path))


def op7_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return found.select("doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept_bytes")).alias("n_removed"), F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE), end_id=1, capacity=4096)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    machine = quality_fm.fit(docs, table(spark, sf_dir, "labels"), "quality", metadata=("n_chars",))
    scored = quality_fm.score(docs, machine)
    return scored.select("doc_id", quality_fm.is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality_fm.THRESHOLD).cast("int").alias("predicted"))


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")), "v1")
    base_failed = F.col("failed").bitwiseAND(F.lit(quality_rules.mask_of("base"))) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), "kept")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS tri
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + o) AS n FROM again, (VALUES (0), (1), (2)) AS t(o) GROUP BY r
), m AS (
  SELECT w.doc_id, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines
  FROM w LEFT JOIN covered ON w.r = covered.r
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 5 * n_symbols > n_words
            OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines) OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM m
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe, op2_merkle, op3_html, op4_tokenbin, op5_simhash, op6_token_counts, op7_suffix, op8_packing, op9_quality, op10_rules)}


def oracle_sql() -> dict[str, str]:
    return {"op10_rules": OP10_SQL}
