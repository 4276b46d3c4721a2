"""Benchmark questions from feed statistics, and the prompt about one feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.scalars import ROUTE_TYPES, blank, coded, fill, fixed, modes_list
from headway.operators.pairs import union_pairs
from headway.operators.ranking import assign_ids, first_n
from headway.plans import views as V
from headway.plans import wording as W
from headway.plans.summarise import FeedSummary
from headway.plans.templates import ORDER, items_from
from headway.schema import BENCHMARK_FIELDS, FEED, POSITION


def route_items(s: FeedSummary) -> DataFrame:
    return items_from(V.network_view(s), W.ROUTE_ANALYSIS, 2)


def schedule_items(s: FeedSummary) -> DataFrame:
    return items_from(V.timetable_view(s), W.SCHEDULE_REASONING, 4)


def size_items(s: FeedSummary) -> DataFrame:
    return items_from(V.feed_view(s), W.NETWORK_SIZE, 6)


def static_items(table: DataFrame, stage: int) -> DataFrame:
    """A user's fixed questions, placed in generation order by ``stage``.

    Terminology and validation come first (0, 1), journeys between route and schedule
    questions (3), operations before the sizes (5).
    """
    order = F.struct(
        F.lit(stage).alias("stage"),
        F.lit("").alias("feed"),
        F.col("question").alias("item"),
        F.lit(0).alias("place"),
    )
    return table.select(*BENCHMARK_FIELDS[1:], F.lit("").alias(FEED), order.alias(ORDER))


def build_benchmark(s: FeedSummary, *static: DataFrame, stored: bool = True) -> DataFrame:
    """All benchmark items with sequence ids in generation order."""
    s = s.stored() if stored else s
    items = union_pairs(route_items(s), schedule_items(s), size_items(s), *static)
    return assign_ids(items, [ORDER, "question"]).select(*BENCHMARK_FIELDS)


def feed_context(s: FeedSummary) -> DataFrame:
    """The facts of a feed as lines of text (``feed_id, context``)."""

    def route_mode() -> Column:
        return F.coalesce(coded(F.col("route_type"), ROUTE_TYPES), F.lit(W.UNSHOWN_MODE))

    first_agency = s.agency.groupBy(FEED).agg(
        F.min_by(F.struct("agency_name", "agency_timezone"), POSITION).alias("agency")
    )
    if s.context_routes is None:
        shown = s.listed_routes.withColumn("_rank", F.col(POSITION))
    else:
        shown = first_n(s.listed_routes, s.context_routes, [FEED], [POSITION])
    shown = shown.withColumn("mode", route_mode()).withColumn(
        "name", F.when(F.col("route_short_name") != "", F.col("route_short_name")).otherwise(
            F.coalesce("route_long_name", F.lit(W.NAMELESS_ROUTE))
        )
    )
    lines = shown.groupBy(FEED).agg(
        F.array_sort(F.collect_list(F.struct("_rank", fill(W.CONTEXT_ROUTE).alias("line")))).alias(
            "lines"
        )
    )
    joined = (
        s.feed_stats.join(first_agency, FEED, "left")
        .join(lines, FEED, "left")
        .withColumn("agency_name", F.col("agency.agency_name"))
        .withColumn("agency_timezone", F.col("agency.agency_timezone"))
        .withColumn("lines", F.array_join(F.transform("lines", lambda x: x["line"]), "\n"))
        .withColumn(
            "mode_counts",
            modes_list(F.col("by_type"), W.MODE_COUNT_ENTRY, ", ", W.UNKNOWN_MODE),
        )
        .withColumn("avg_stops", _average("avg_stops_per_route"))
        .withColumn("avg_trips", _average("avg_trips_per_route"))
    )
    text = F.concat_ws(
        "\n",
        F.when(F.col("agency").isNotNull(), fill(W.CONTEXT_AGENCY)),
        fill(W.CONTEXT_ROUTES),
        F.when(blank(F.col("mode_counts")) != "", fill(W.CONTEXT_TYPES)),
        F.when(F.col("lines").isNotNull(), fill(W.CONTEXT_DETAILS)),
        fill(W.CONTEXT_STOPS),
        fill(W.CONTEXT_SERVICES),
        F.when(F.col("range_start").isNotNull(), fill(W.CONTEXT_RANGE)),
        fill(W.CONTEXT_TRANSFERS),
        fill(W.CONTEXT_NETWORK),
    )
    return joined.select(FEED, text.alias("context"))


def _average(c: str) -> Column:
    return F.when(F.col("total_routes") == 0, "0").otherwise(fixed(F.col(c), 1))


def feed_prompt(context: DataFrame, question: str | Column) -> DataFrame:
    """The text asking a question about each feed."""
    asked = F.lit(question) if isinstance(question, str) else question
    return context.withColumn("prompt", fill(W.PROMPT, question=asked))
