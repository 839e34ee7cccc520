"""A corpus from raw documents: language ID, line dedup, near-duplicate removal, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow.llm import language, line_chunks, mixing, ngram_join, packing
from feeflow.llm.store import checked_broadcast, saved, small_batches

# A text is rejected when no language holds this share of its letters.
LEAST_SHARE = 0.5


# Documents are named by id and text hash: ids may be null or repeated, and no row number has
# to be written with the texts.
def _name():
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("xh"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letters, or none with half of them. The others keep
    their columns; ``lang`` stays the given label."""
    held_out = language.is_held_out("doc_id")
    model = language.train(docs.filter(~held_out), "doc_id", "text", "lang")
    some = docs.filter("text is not null")
    labels = language.predict(some.select(F.xxhash64("text").alias("doc_id"), "text"), model)
    bad = labels.filter((F.col("lang_pred") == "und") | (F.col("score") < LEAST_SHARE))
    with small_batches(spark):
        bad = saved(bad.select(F.col("doc_id").alias("__bad")).distinct(), "rejected")
    return some.join(checked_broadcast(bad), F.xxhash64("text") == F.col("__bad"), "left_anti")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of lines leave the texts; a text that loses all it had goes."""
    cols = docs.columns
    out = line_chunks.dedup_line_passages(docs)
    left = F.col("text").isNotNull() & (F.col("text") != "")
    out = out.filter((F.col("n_removed_lines") == 0) | left)
    new_size = F.when(F.col("n_removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", new_size).select(cols)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest (id, text hash); of equal
    rows one."""
    groups = saved(ngram_join.ngram_jaccard_join(docs.select(_name().alias("doc_id"), "text")), "groups")
    gone = saved(groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    kept = docs.join(checked_broadcast(gone), _name() == F.col("__gone"), "left_anti")
    repeated = groups.filter("n_shingles > 0").groupBy("doc_id").count().filter("count > 1")
    return kept if repeated.isEmpty() else kept.withColumn("__name", _name()).dropDuplicates(["__name"]).drop("__name")


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0 times: it goes)."""
    taken = mixing.mix_to_targets(docs.select(_name().alias("doc_id"), "text", "source"))
    taken = taken.filter("copies > 0").groupBy(F.col("doc_id").alias("__name")).agg(F.max("copies").alias("__copies"))
    again = docs.join(checked_broadcast(saved(taken, "taken")), _name() == F.col("__name"))
    return again.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("mixing", mixing_to_targets),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


# Viterbi labels and the packing program have no SQL form; tests/llm checks every stage.
ORACLE_SQL = None
