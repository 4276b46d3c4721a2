"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import (
    decontamination, hard_negatives, jaccard_join, language, licences, merkle_log, packing,
    page_text, pii, quality, repeats, sharding, token_counts,
)
from headway.llm.common import table
from headway.llm.oracle import HARD_NEGATIVES, MERKLE, REPEATS

QUERIES = {}
SQL: dict[str, str] = {}
RANKS = "byte_bpe_50k.tiktoken"


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query("op1_token_counts")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, counted in flat token files without an index."""
    return token_counts.count_documents(table(spark, folder, "documents"), public_tokenizers.path(RANKS))


@query("op2_packing")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path(RANKS))


@query("op3_personal_data")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    field = pii.train(pii.labelled_sample(docs))
    return pii.find_personal_data(docs, field).select(
        "doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"), "spans"
    )


@query("op4_jaccard_join")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents with similar sets of five-word shingles."""
    return jaccard_join.similar_texts(table(spark, folder, "documents"))


@query("op5_sharding")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards with equal counts, copies together."""
    return sharding.shard_documents(table(spark, folder, "documents"))


@query("op6_page_text")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return page_text.main_texts(table(spark, folder, "pages"))


def held_out() -> Column:
    """Documents that no model learns from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


@query("op7_language")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents, learned from four fifths of them."""
    docs = table(spark, folder, "documents")
    model = language.trained(docs, ~held_out())
    rows = docs.select("doc_id", "text", F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    return language.identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")


@query("op8_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and verdict of a learned decision list for all documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rules = quality.learned(docs, table(spark, folder, "labels"))
    return quality.judged(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query("op9_licences")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and notices in all documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licences.scan_licences(docs).select("doc_id", *licences.NAMES)


@query("op10_decontamination")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontamination.contaminations(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query("op11_repeats", REPEATS)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of all documents outside of repeated strings of 200 bytes."""
    return repeats.removed_repeats(table(spark, folder, "documents"))


@query("op12_merkle_manifest", MERKLE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Merkle proofs of all documents; a fifth of them is checked against an altered text."""
    docs = table(spark, folder, "documents")
    return merkle_log.manifest(docs, held_out(), {"text": merkle_log.lowered()})


@query("op13_hard_negatives", HARD_NEGATIVES)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth vector among all vectors."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, label=moved)
