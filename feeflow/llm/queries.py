"""Registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow.llm import byte_bpe, embedding_tiles, fill_middle, language, line_chunks, lm_scores, mixing, ngram_join, packing, quality, repeats, token_counts, whitening

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_to_targets(_table(spark, sf_dir, "documents")).drop("copies")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = language.is_held_out("doc_id")
    model = language.train(docs.filter(~held_out), "doc_id", "text", "lang")
    out = language.predict(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_chunks.dedup_line_passages(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_tiles.embedding_near_dedup(_table(spark, sf_dir, "embeddings"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.lm_scores(_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(fill_middle.restored()).alias("restored_sha256")
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_bpe.decode(byte_bpe.encode(_table(spark, sf_dir, "documents")))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("ids_bytes", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_ngram_jaccard_join, op3_token_counts, op4_language_id, op5_packing,
        op6_line_dedup, op7_suffix_array_dedup, op8_quality_rules, op9_embedding_near_dedup, op10_lm_scores,
        op11_fill_in_middle, op12_embedding_whitening, op13_byte_bpe,
    )
}

# DuckDB SQL of the queries that it can express.
ORACLE: dict[str, str] = {
    "op11_fill_in_middle": r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM units
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(u[b + 1:], ''), '') AS suffix
  FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
}
