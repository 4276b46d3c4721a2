"""Scores of predicted answers and their aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.scalars import stripped
from headway.functions.texts import (
    SCORE_WEIGHTS,
    combined_score,
    criteria_match,
    keyword_match,
    rouge_l,
    tokens,
    verdict,
)
from headway.operators.cleaning import keep_first

SCORES = ("rouge_l", "keyword_match", "criteria_match", "combined")


def predictions_with_expected(predictions: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Predicted answers next to the benchmark items of the same id."""
    return benchmark.join(predictions, "id")


def score_answers(answers: DataFrame, weights=SCORE_WEIGHTS, stems=tokens) -> DataFrame:
    """Adds the four scores to ``expected_answer, scoring_criteria, generated``.

    ``stems`` turns a text column into the token array compared by ROUGE-L.
    """
    expected, generated = F.col("expected_answer"), F.col("generated")
    # columns of their own, so that a text is taken apart once however often ROUGE-L reads it
    stemmed = answers.withColumns({"_expected": stems(expected), "_generated": stems(generated)})
    return (
        stemmed.withColumn("rouge_l", rouge_l(F.col("_expected"), F.col("_generated")))
        .drop("_expected", "_generated")
        .withColumn("keyword_match", keyword_match(expected, generated))
        .withColumn("criteria_match", criteria_match(F.col("scoring_criteria"), generated))
        .withColumn(
            "combined", combined_score(*[F.col(c) for c in SCORES[:3]], weights=weights)
        )
    )


def score_report(scored: DataFrame) -> DataFrame:
    """Mean scores overall, per category, per category and difficulty, per difficulty.

    One pass over the rows; ``level`` tells the four kinds of rows apart.
    """
    named = scored.select(
        F.coalesce("category", F.lit("unknown")).alias("category"),
        F.coalesce("difficulty", F.lit("medium")).alias("difficulty"),
        *SCORES,
    )
    report = named.groupingSets(
        [[], ["category"], ["category", "difficulty"], ["difficulty"]], "category", "difficulty"
    ).agg(
        F.grouping_id().alias("g"),
        F.count(F.lit(1)).alias("count"),
        *[F.round(F.avg(s), 4).alias(f"{s}_avg") for s in SCORES],
    )
    # grouping_id: the bit of a column is set where it is grouped away
    level = (
        F.when(F.col("g") == 0b11, "overall")
        .when(F.col("g") == 0b01, "category")
        .when(F.col("g") == 0b10, "difficulty")
        .otherwise("category_difficulty")
    )
    return report.select(level.alias("level"), *[c for c in report.columns if c != "g"])


def compare_reports(base: DataFrame, candidate: DataFrame) -> DataFrame:
    """Combined score per category in two reports, a missing category as 0."""

    def side(report: DataFrame, name: str) -> DataFrame:
        return report.where("level = 'category'").select(
            "category", F.col("combined_avg").alias(name)
        )

    joined = side(base, "base").join(side(candidate, "candidate"), "category", "full")
    return _with_delta(joined, "category")


def compare_many(
    reports: dict[str, DataFrame], start: str, end: str, level: str = "category"
) -> DataFrame:
    """Combined score per category in several reports, one column each.

    ``delta`` is the change from one of the reports to another; a missing category
    counts as 0.
    """
    rows = [
        report.where(F.col("level") == level).select(
            level, "combined_avg", F.lit(name).alias("run")
        )
        for name, report in reports.items()
    ]
    wide = (
        reduce(DataFrame.unionByName, rows)
        .groupBy(level)
        .pivot("run", list(reports))
        .agg(F.max("combined_avg"))
        .fillna(0.0, list(reports))
    )
    delta = F.round(F.col(end) - F.col(start), 4)
    return wide.withColumn("delta", delta).withColumn(
        "sign", F.when(delta > 0, "+").otherwise("")
    )


def compare_overall(base: DataFrame, candidate: DataFrame) -> DataFrame:
    """The four overall scores of two reports."""

    def side(report: DataFrame, name: str) -> DataFrame:
        columns = ", ".join(f"'{s}', {s}_avg" for s in SCORES)
        return report.where("level = 'overall'").selectExpr(
            f"stack({len(SCORES)}, {columns}) as (metric, {name})"
        )

    return _with_delta(
        side(base, "base").join(side(candidate, "candidate"), "metric", "full"), "metric"
    )


def _with_delta(joined: DataFrame, by: str) -> DataFrame:
    filled = joined.select(
        by, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("base", "candidate")]
    )
    delta = F.round(F.col("candidate") - F.col("base"), 4)
    return filled.withColumn("delta", delta).withColumn(
        "sign", F.when(delta > 0, "+").otherwise("")
    )


def overall_verdict(overall: DataFrame, base: str, candidate: str) -> DataFrame:
    """The statement on the overall combined score."""
    return overall.where("metric = 'combined'").select(
        "delta", verdict(F.col("delta"), base, candidate).alias("verdict")
    )


def answer_lookup(
    questions: DataFrame, answers: DataFrame, otherwise: str, order=("question",)
) -> DataFrame:
    """Answers found by question text, blanks around and letter case ignored.

    Of several equal texts among the answers the first counts.
    """
    known = keep_first(
        answers.withColumn("_key", F.lower("question")), ["_key"], order
    ).select("_key", "answer")
    return (
        questions.withColumn("_key", F.lower(stripped(F.col("question"))))
        .join(known, "_key", "left")
        .withColumn("answer", F.coalesce("answer", F.lit(otherwise)))
        .drop("_key")
    )
