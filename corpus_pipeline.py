"""Corpus pipeline: documents to packed training sequences, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import decontamination, jaccard_join, language, packing, pii
from headway.llm.common import stored, table
from headway.llm.queries import RANKS, held_out

LEAST_SCORE = 0.02
LEAST_CHARS = 200


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those of ``LEAST_CHARS`` or more that no language
    codes shorter than frequencies of bytes do.

    Null and empty texts have no letter and go. Repeated rows are judged alike. An empty table
    stays empty; without a labelled text nothing can be told and only documents without a letter go.
    """
    model = language.trained(docs, F.coalesce(~held_out(), F.lit(True)))
    judged = language.identify(docs.withColumnsRenamed({"lang_pred": "_lang_pred", "score": "_score"}), model)
    told = F.col("score") >= LEAST_SCORE if model.languages else F.lit(True)
    letters = F.coalesce(F.col("text").rlike(language.LETTERS), F.lit(False))
    kept = judged.filter(letters & (told | (F.length("text") < LEAST_CHARS)))
    return kept.drop("lang_pred", "score").withColumnsRenamed({"_lang_pred": "lang_pred", "_score": "score"})


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the least doc_id stays.

    Texts without words are similar to nothing and stay; of equal rows one stays. Without a
    doc_id a document comes last in its component.
    """
    return jaccard_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; null and empty texts hold none."""
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars follows the text. A null text stays null."""
    field = pii.train(pii.labelled_sample(docs))
    found = pii.find_personal_data(docs, field).withColumn("text", F.col("masked"))
    if "n_chars" in docs.columns:
        changed = F.col("spans") != ""
        found = found.withColumn(
            "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    return found.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens; a null text is its end mark only."""
    return packing.pack_documents(docs, public_tokenizers.path(RANKS))


STAGES = [
    ("language", keep_known_languages),
    ("jaccard_join", keep_one_of_similar),
    ("decontamination", drop_benchmark),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

# Trained models and a tokenizer decide what remains; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
