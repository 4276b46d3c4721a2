import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.functions.texts import TERM_BREAK, TOKEN, common_length
from headway.operators import scoring as S
from headway.plans.score_runs import compare_runs, score_benchmark


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [
            ("1", "It has 12 routes.", "Must state 12 routes", "easy", "size"),
            ("2", "Service runs daily.", "Must mention: daily, service", "hard", "size"),
            ("3", "Nothing.", "", None, None),
            ("4", "Unanswered.", "Must mention: x", "easy", "other"),
        ],
        "id string, expected_answer string, scoring_criteria string, difficulty string,"
        " category string",
    )


@pytest.fixture(scope="module")
def run(spark, benchmark):
    answers = [("1", "It has 12 routes."), ("2", "Runs daily"), ("3", "")]
    return score_benchmark(spark.createDataFrame(answers, "id string, generated string"), benchmark)


def test_scores(run):
    found = {r.id: r for r in run.answers.collect()}
    assert set(found) == {"1", "2", "3"}
    one, two, three = (found[i] for i in "123")
    assert (one.rouge_l, one.keyword_match, one.criteria_match) == (1.0, 1.0, 1.0)
    assert one.combined == pytest.approx(1.0)
    assert (two.rouge_l, two.keyword_match, two.criteria_match) == (pytest.approx(0.8), 1.0, 0.5)
    assert (three.rouge_l, three.keyword_match, three.criteria_match) == (0.0, 1.0, 0.0)


def test_report(run):
    found = {(r.level, r.category, r.difficulty): r for r in run.report.collect()}
    assert found["overall", None, None]["count"] == 3
    assert found["category", "size", None].combined_avg == pytest.approx(0.885)
    assert found["category", "unknown", None].combined_avg == pytest.approx(0.3)
    assert found["difficulty", None, "medium"]["count"] == 1
    assert found["category_difficulty", "size", "hard"].rouge_l_avg == 0.8
    assert len(found) == 1 + 2 + 3 + 3


def test_examples(run):
    assert rows(run.examples.where("category = 'size'"), "which", "id") == [
        ("best", "1"), ("worst", "2")
    ]


def report(spark, overall, **categories):
    data = [("overall", None, None, 1, overall)]
    data += [("category", c, None, 1, v) for c, v in categories.items()]
    df = spark.createDataFrame(
        data, "level string, category string, difficulty string, count int, combined_avg double"
    )
    for s in S.SCORES[:3]:
        df = df.withColumn(f"{s}_avg", df.combined_avg)
    return df


@pytest.mark.parametrize(
    ("delta", "verdict"),
    [
        (0.06, "new significantly outperforms the old."),
        (0.05, "new slightly outperforms the old."),
        (0.0, "Performance is roughly equivalent."),
        (-0.05, "The old outperforms new."),
    ],
)
def test_comparison(spark, delta, verdict):
    a = report(spark, 0.3, x=0.2, y=0.5)
    b = report(spark, round(0.3 + delta, 4), y=0.4, z=0.1)
    done = compare_runs(a, b, "old", "new")
    assert rows(done.categories) == [
        ("x", 0.2, 0.0, -0.2, ""), ("y", 0.5, 0.4, -0.1, ""), ("z", 0.0, 0.1, 0.1, "+")
    ]
    (found,) = done.verdict.collect()
    assert found.verdict == verdict
    assert done.overall.count() == 4


def test_lookup(spark):
    questions = spark.createDataFrame([(" what IS it? ",), ("else",)], "question string")
    answers = spark.createDataFrame([("What is it?", "a"), ("WHAT IS IT?", "b")],
                                    "question string, answer string")
    found = S.answer_lookup(questions, answers, "none", ["answer"])
    assert rows(found, "question", "answer") == [(" what IS it? ", "a"), ("else", "none")]


def test_texts_are_taken_apart_once(spark, benchmark):
    answered = benchmark.withColumn("generated", F.upper("expected_answer"))
    plan = S.score_answers(answered)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(TOKEN) == 2  # expected and generated
    assert plan.count(TERM_BREAK) == 1


def test_common_length_of_awkward_lists(spark):
    pairs = [
        (["a", "x", "b", "c"], ["b", "a", "y", "c"], 2),
        ([], ["a"], 0),
        (["a"], ["a"], 1),
        (["a", None, "b"], ["c", None, "b", "d"], 2),
        (None, ["a"], None),
        (["a b", "c", "é"], ["é", "a b", "c"], 2),
    ]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>, n int").coalesce(1)
    for r in df.select("*", common_length(F.col("a"), F.col("b")).alias("found")).collect():
        assert r.found == r.n, r
