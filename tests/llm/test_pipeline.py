"""The pipeline stage by stage, and the registered queries of the corpus operators."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm import language
from headway.llm.common import stored, table
from headway.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_clean_documents(spark):
    docs = table(spark, FOLDER, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER), "test")
        assert docs.columns == columns, name
        after = docs.count()
        assert 0.5 * before < after <= before, name
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert docs.filter("text like '%@mail%'").count() == 0


def test_language_stage_drops_what_is_no_language(spark):
    r = random.Random(3)
    docs = table(spark, FOLDER, "documents")
    noise = ["".join(chr(r.randint(97, 122)) for _ in range(600)), "12 34 !?", None, "", " \n"]
    planted = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(noise)], "doc_id long, text string")
    mixed = docs.unionByName(planted, allowMissingColumns=True).withColumn("lang_pred", F.lit("kept"))
    mixed = mixed.unionByName(mixed.limit(3))  # repeated rows
    kept = corpus_pipeline.keep_known_languages(spark, mixed, FOLDER)
    assert kept.columns == mixed.columns and kept.filter("lang_pred <> 'kept'").count() == 0
    assert kept.filter("doc_id < 0").count() == 0
    assert kept.count() >= 0.98 * docs.filter("text rlike '[a-zA-Z]'").count()


def test_pipeline_of_awkward_documents(spark):
    """Nulls, empty and long texts, copies and clashing columns go through all stages."""
    r = random.Random(5)
    long = " ".join(f"word{r.randint(0, 500)}" for _ in range(30_000))
    rows = [(1, long), (2, long), (3, None), (None, "the end of it"), (4, ""), (4, ""), (5, "mail a.b@example.com now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({
        "lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long"),
        "component_id": F.lit("x"), "key": F.lit(1), "spans": F.lit("y"), "score": F.lit(0),
    })
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stored(stage(spark, docs, FOLDER), "test")
        assert found.columns == docs.columns, name
        docs = found
    left = {x.doc_id: x.text for x in docs.collect()}
    assert set(left) == {1, None, 5} and left[1] == long and "@" not in left[5]


def test_pipeline_of_no_documents(spark):
    docs = table(spark, FOLDER, "documents").filter("1 = 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "test")
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in ("op6_page_text", "op10_decontamination", "op13_hard_negatives"):
        return  # rows are no documents
    found = QUERIES[name](spark, FOLDER)
    assert found.select("doc_id").distinct().count() == table(spark, FOLDER, "documents").count()


def test_held_out_accuracy(spark):
    found = QUERIES["op7_language"](spark, "/root/testdata/sf0.01").filter("held_out")
    truth = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    both = found.join(truth, "doc_id").filter(f"lang_pred != '{language.UNKNOWN}'")
    assert both.filter("lang = lang_pred").count() > 0.95 * both.count()
