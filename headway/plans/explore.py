"""A first look at one feed: validation, summary and a text about it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.plans.benchmark_items import feed_context, feed_prompt
from headway.plans.clean_feeds import clean_feeds, load_tables
from headway.plans.summarise import FeedSummary
from headway.sources import archives as A

# The smaller samples of a first look, unknown stops shown by their id.
FIRST_LOOK = {"sampled_stops": 50, "sampled_transfers": 30, "missing": "id"}


@dataclass(frozen=True)
class Exploration:
    """``summary`` is absent where the archive is not valid."""

    validation: DataFrame
    summary: FeedSummary | None

    def prompt(self, question: str) -> DataFrame:
        return feed_prompt(feed_context(self.summary), question)


def explore_feed(
    spark: SparkSession, archives: str, feed_id: str, raw: str, out: str,
    opener: A.Opener = A.open_shared,
) -> Exploration:
    """Validates, cleans and summarises one feed of a folder of archives."""
    paths = A.archive_paths(spark, archives).where(A.feed_of(F.col("path")) == feed_id)
    validation = A.validate_archives(A.list_archives(A.latest_per_feed(paths), opener))
    verdict = validation.select("is_valid").first()  # one row: the feed
    if verdict is None or not verdict.is_valid:
        return Exploration(validation, None)
    clean_feeds(spark, paths, raw, out, feed_ids=[feed_id], replace=True, opener=opener)
    return Exploration(
        validation, FeedSummary(load_tables(spark, out, feed_ids=[feed_id]), **FIRST_LOOK)
    )
