"""Checks of a pair dataset, its split and the report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators import pairs as P
from headway.operators.ranking import number_rows, seeded, stratified_split
from headway.schema import PAIR_FIELDS
from headway.sources.documents import BAD, read_pairs, write_report, write_splits

RECORD = "record"


@dataclass(frozen=True)
class Validation:
    split: DataFrame
    report: DataFrame

    def write(self, folder: str) -> None:
        write_splits(self.split, f"{folder}/pairs")
        write_report(self.report, f"{folder}/report")


def load_numbered(spark, path: str) -> DataFrame:
    """Valid pairs of a file with their record number, counted from 0 in file order."""
    pairs = read_pairs(spark, path, keep_invalid=True).where(F.col(BAD).isNull()).drop(BAD)
    return number_rows(pairs, ["_pos"], "_n").withColumn(RECORD, F.col("_n") - 1).drop("_n", "_pos")


def distribution_check(pairs: DataFrame) -> DataFrame:
    """One row: the distribution as maps."""
    counted = P.pair_distribution(pairs)

    def counts(dimension: str, value: str = "n"):
        entries = F.collect_list(
            F.when(F.col("dimension") == dimension, F.struct("value", value))
        )
        return F.map_from_entries(F.array_sort(entries))

    def number(dimension: str):
        return F.count_if(F.col("dimension") == dimension)

    return counted.agg(
        F.lit("distribution").alias("check"),
        F.max(F.when(F.col("dimension") == "all", F.col("n"))).alias("total_pairs"),
        counts("category").alias("categories"),
        counts("category", "percent").alias("category_percentages"),
        number("feed").alias("feeds_covered"),
        counts("feed").alias("feed_counts"),
        number("template").alias("unique_templates"),
        counts("template").alias("template_counts"),
    )


def validate_pairs(
    pairs: DataFrame,
    feed_stats: DataFrame,
    ratio: float = 0.9,
    seed: int = 42,
    line: str | None = None,
) -> Validation:
    """All checks, a stratified split and the report.

    ``pairs`` has a column ``record``, unique and in dataset order. ``line`` names the
    column with the JSON line a pair was read from; without it every field is taken to
    be present.
    """
    if line is None:
        pairs = pairs.withColumn(
            "_line", F.to_json(F.struct(*PAIR_FIELDS), {"ignoreNullFields": "false"})
        )
        line = "_line"
    split = stratified_split(pairs.select(RECORD, *PAIR_FIELDS), ratio, seed, key=[RECORD])
    sizes = split.agg(
        F.count(F.lit(1)).alias("total_pairs"),
        F.count_if(F.col("split") == "train").alias("train_size"),
        F.count_if(F.col("split") == "test").alias("test_size"),
    )
    checks = [
        P.check_format(pairs, RECORD, line),
        P.check_content(pairs, RECORD),
        P.check_duplicates(pairs, [RECORD]),
        distribution_check(pairs),
        P.check_facts(pairs, feed_stats),
    ]
    shuffled = split.orderBy("split", seeded([RECORD], seed + 1)).drop(RECORD)
    return Validation(shuffled, P.validation_report(checks, sizes, ratio))
