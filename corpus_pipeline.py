"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stages before it kept. Columns
beyond those of ``documents`` pass through; null and empty texts are texts like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolink.llm import packing, pii, simhash, suffix_dedup, toxicity
from chronolink.llm.common import small_batches, table, written
from chronolink.llm.queries import gpt_encoder


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, brought in line with a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that the model, fitted on the labelled ones, calls toxic."""
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("text", F.struct(*docs.columns).alias("_llm_row")), model)
    return scored.filter("predicted = 0").select("_llm_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies keep the row with the least id and text hash, null ids last; rows equal
    in id and text stay once, with the other columns of any one of them."""
    small_batches(spark)
    text = F.xxhash64("text")
    rows = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), text.alias("hash"))
    found = simhash.near_duplicates(docs.select(rows.alias("doc_id"), "text"))
    kept = found.filter("doc_id <=> component_id").select(
        F.col("doc_id.id").alias("_llm_id"), F.col("doc_id.hash").alias("_llm_kept_hash")
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_llm_id")) & (F.col("_llm_hash") == F.col("_llm_kept_hash"))
    hashed = docs.withColumn("_llm_hash", text)
    return hashed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_llm_hash"]).drop("_llm_hash")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every long string that starts in more than one place out of all texts."""
    small_batches(spark)
    cut = suffix_dedup.dedup(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_llm_kept_row")), with_text=True)
    row = F.col("_llm_kept_row")
    columns = [
        F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(row["text"]).alias("text") if c == "text" else row[c].alias(c)
        for c in docs.columns
    ]
    return with_length(cut.select(*columns))


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind."""
    return with_length(pii.redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    small_batches(spark)
    return packing.pack(docs, gpt_encoder)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("pii", redact_personal),
    ("packing", pack_sequences),
]

#: A fitted model decides what stays, which SQL cannot state. The tests hold each stage against the operator it applies; the
#: operators have comparisons with brute force, exact round trips or held-out accuracy of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each reads what the one before it has written."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
