"""The registered queries of the subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolink.llm import bpe, compact_windows, conversation_repair, dual_tree, hash_forest, oracles, packing, paragraph_sketch, pii, secret_scan, sentence_pieces, simhash, suffix_dedup, toxicity
from chronolink.llm.common import small_batches, table
from chronolink.llm.packing import byte_level_encoder

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def gpt_encoder():
    """The encoder of the public byte-level vocabulary, found on the worker that asks for it."""
    import public_tokenizers

    return byte_level_encoder(public_tokenizers.path("byte_bpe_50k.json"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), gpt_encoder)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    names = ("assign", "access", "hex")
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{n}')) AS long)").alias(f"n_{n}") for n in names]
    base = F.filter("spans", lambda s: s["kind"].isin(*names))
    return found.select(
        "doc_id", *counts, F.sha2(pii.listing(base), 256).alias("base_sha256"), pii.listing(F.col("spans")).alias("spans")
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = [k.name for k in pii.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(names))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{n}')) AS long)").alias(f"n_{n}") for n in names]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listing(base), 256).alias("base_sha256"), pii.listing(F.col("spans")).alias("spans")
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.repeated_passages(table(spark, sf_dir, "documents"))


def op8_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_sketch.fingerprints(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode_decode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op10_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hash_forest.nearest(rows, rows.filter("vec_id % 20 = 0"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = sentence_pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return sentence_pieces.encode_decode(table(spark, sf_dir, "documents"), model)


def op12_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired(table(spark, sf_dir, "conversations"))


def _bounded(query: Query) -> Query:
    """``query`` with small batches for its Python workers, so that long texts do not add up."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = {"op1_simhash": op1_simhash, "op2_packing": op2_packing, "op3_secret_scan": op3_secret_scan,
        "op4_toxicity": op4_toxicity, "op5_pii": op5_pii,
        "op6_suffix_dedup": op6_suffix_dedup, "op7_compact_windows": op7_compact_windows, "op8_paragraph_sketch": op8_paragraph_sketch,
        "op9_bpe": op9_bpe, "op10_hash_forest": op10_hash_forest,
        "op11_sentencepiece": op11_sentencepiece, "op12_dual_tree": op12_dual_tree,
        "op13_conversation_repair": op13_conversation_repair,
    }
    return {name: _bounded(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op12_dual_tree": oracles.DUAL_TREE_SQL, "op13_conversation_repair": oracles.REPAIR_SQL}
