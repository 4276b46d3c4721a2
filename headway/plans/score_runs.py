"""Scoring of a run and comparison of two runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from headway.functions.texts import SCORE_WEIGHTS, tokens
from headway.operators import scoring as S
from headway.operators.ranking import best_and_worst


@dataclass(frozen=True)
class RunScores:
    """Scored answers of one run and their report."""

    answers: DataFrame
    report: DataFrame

    @property
    def examples(self) -> DataFrame:
        """The best and the worst answer per category."""
        return best_and_worst(self.answers)


def score_benchmark(
    predictions: DataFrame, benchmark: DataFrame, weights=SCORE_WEIGHTS, stems=tokens
) -> RunScores:
    answers = S.score_answers(
        S.predictions_with_expected(predictions, benchmark), weights, stems
    )
    return RunScores(answers, S.score_report(answers))


@dataclass(frozen=True)
class RunComparison:
    overall: DataFrame
    categories: DataFrame
    verdict: DataFrame


def compare_runs(
    base: DataFrame, candidate: DataFrame, base_name: str = "base model",
    candidate_name: str = "candidate",
) -> RunComparison:
    """Two score reports side by side."""
    overall = S.compare_overall(base, candidate)
    return RunComparison(
        overall,
        S.compare_reports(base, candidate),
        S.overall_verdict(overall, base_name, candidate_name),
    )
