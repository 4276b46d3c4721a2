"""Fact views the templates are applied to; each has feed_id, provider and item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.scalars import (
    avg_headway,
    blank,
    display_name,
    fill,
    fixed,
    format_gtfs_time,
    full_name,
    modes_list,
    modes_text,
    route_type_name,
    service_span,
    transfer_type_name,
)
from headway.operators import ranking as R
from headway.operators import summaries as S
from headway.operators.schedules import early_routes, late_routes, scheduled_routes
from headway.operators.single import beside
from headway.plans import wording as W
from headway.plans.summarise import FeedSummary
from headway.schema import FEED, POSITION


def _rank_text(c: str) -> Column:
    """A number as text that sorts like the number."""
    return F.lpad(F.col(c).cast("string"), 12, "0")


def _name() -> Column:
    return blank(display_name(F.col("route_short_name"), F.col("route_long_name")))


def _minutes() -> Column:
    return F.expr("min_transfer_time div 60")


def _average(c: str) -> Column:
    return F.when(F.col("total_routes") == 0, "0").otherwise(fixed(F.col(c), 1))


def mode_names(by_type: Column) -> Column:
    """Names of the modes in code order."""
    return F.array_join(
        F.transform(
            F.array_sort(F.map_keys(by_type)),
            lambda k: route_type_name(k, unknown=W.UNKNOWN_MODE),
        ),
        ", ",
    )


def feed_view(s: FeedSummary) -> DataFrame:
    return s.feed_stats.withColumn("avg_stops", _average("avg_stops_per_route")).withColumn(
        "item", F.lit("")
    )


def agency_view(s: FeedSummary) -> DataFrame:
    totals = s.feed_stats.select(
        FEED, "provider", "total_routes", "total_stops", "total_trips", "by_type"
    )
    return (
        s.agency.join(totals, FEED)
        .withColumn("modes", F.when(F.size("by_type") > 0, modes_text(F.col("by_type"))))
        .withColumn("breakdown", modes_list(F.col("by_type"), W.BREAKDOWN_ENTRY, ". "))
        .withColumn("item", F.col("agency_id"))
    )


def _described(routes: DataFrame, s: FeedSummary) -> DataFrame:
    return (
        routes.join(s.feeds.select(FEED, "provider"), FEED)
        .withColumn("name", _name())
        .withColumn(
            "full_name", blank(full_name(F.col("route_short_name"), F.col("route_long_name")))
        )
        .withColumn("mode", F.coalesce(route_type_name(F.col("route_type")), F.lit(W.NO_MODE)))
        .withColumn("destinations", F.array_join(F.slice("headsigns", 1, 3), ", "))
        .withColumns(_times_shown())
    )


def _times_shown() -> dict[str, Column]:
    return {
        f"{end}_shown": format_gtfs_time(F.col(f"{end}_departure")) for end in ("first", "last")
    }


def route_view(s: FeedSummary) -> DataFrame:
    """The routes picked for questions."""
    picked = R.pick_routes(s.listed_routes, s.asked_routes, s.seed)
    return _described(picked, s).withColumn("item", _rank_text("pick"))


def route_type_view(s: FeedSummary) -> DataFrame:
    """Per feed and route type: how many listed routes, and the first names."""
    named = (
        s.listed_routes.where("route_type is not null")
        .withColumn("name", _name())
        .select(FEED, F.col("route_type").cast("int").alias("route_type"), "name", POSITION)
    )
    totals = named.groupBy(FEED, "route_type").agg(F.count(F.lit(1)).alias("n"))
    first = R.first_n(named, s.names_listed, [FEED, "route_type"], [POSITION])
    names = first.groupBy(FEED, "route_type").agg(
        F.array_sort(F.collect_list(F.struct("_rank", "name"))).alias("names")
    )
    shown = F.filter(F.transform("names", lambda x: x["name"]), lambda n: n != "")
    return (
        totals.join(names, [FEED, "route_type"])
        .join(s.feeds.select(FEED, "provider"), FEED)
        .withColumn("names", F.array_join(shown, ", "))
        .withColumn("more", F.col("n") - s.names_listed)
        .withColumn("mode", route_type_name(F.col("route_type")))
        .withColumn("item", _rank_text("route_type"))
    )


def stop_view(s: FeedSummary) -> DataFrame:
    drawn = s.sample_stops.where(F.col("draw") <= s.asked_stops)
    return drawn.join(s.feeds.select(FEED, "provider"), FEED).withColumn(
        "item", _rank_text("draw")
    )


def transfer_view(s: FeedSummary) -> DataFrame:
    drawn = s.sample_transfers.where(F.col("draw") <= s.asked_transfers)
    return (
        drawn.join(s.feeds.select(FEED, "provider"), FEED)
        .withColumn("kind", transfer_type_name(F.col("transfer_type")))
        .withColumn("minutes", _minutes())
        .withColumn("item", _rank_text("draw"))
    )


def journey_view(s: FeedSummary) -> DataFrame:
    """One row per feed with a provider and a scheduled route."""
    scheduled = scheduled_routes(s.listed_routes, need_names=False).withColumn("name", _name())
    # the first route by position, kept as a running minimum
    early = early_routes(scheduled).groupBy(FEED).agg(
        F.min_by(F.struct("name", "first_departure"), POSITION).alias("early")
    )
    late = late_routes(scheduled).groupBy(FEED).agg(
        F.min_by(F.struct("name", "last_departure"), POSITION).alias("late")
    )
    busiest = scheduled.groupBy(FEED).agg(
        F.count(F.lit(1)).alias("scheduled"),
        F.min_by(
            F.struct("name", "trip_count"), F.struct(-F.col("trip_count"), POSITION)
        ).alias("busiest"),
    )
    transfer = s.sample_transfers.where("draw = 1").select(
        FEED, "from_stop_name", "to_stop_name", "min_transfer_time", F.lit(True).alias("has_transfer")
    )
    return (
        s.feed_stats.where("provider <> ''")
        .join(busiest, FEED)
        .join(early, FEED, "left")
        .join(late, FEED, "left")
        .join(transfer, FEED, "left")
        .select(
            "*",
            F.col("early.name").alias("early_name"),
            F.col("early.first_departure").alias("early_departure"),
            F.col("late.name").alias("late_name"),
            F.col("late.last_departure").alias("late_departure"),
            F.col("busiest.name").alias("busiest_name"),
            F.col("busiest.trip_count").alias("busiest_trips"),
            _minutes().alias("minutes"),
            mode_names(F.col("by_type")).alias("mode_names"),
            F.lit("").alias("item"),
        )
    )


def ranking_view(s: FeedSummary, metric: str, entry: str, k: int = 5) -> DataFrame:
    """The winner by a metric and the top k as a list."""
    top = R.top_feeds(s.feed_stats, metric, k).withColumn("total", F.col(metric))
    listed = F.array_sort(F.collect_list(F.struct("rank", fill(entry).alias("text"))))
    return top.agg(
        F.min_by("provider", "rank").alias("provider"),
        F.min_by("country_code", "rank").alias("country_code"),
        F.min_by("total", "rank").alias("total"),
        F.array_join(F.transform(listed, lambda x: x["text"]), ", ").alias("top"),
    ).where("provider is not null")


def neighbour_view(s: FeedSummary) -> DataFrame:
    return R.neighbour_pairs(_pair_columns(s)).withColumn("item", _rank_text("pair"))


def shuffled_view(s: FeedSummary) -> DataFrame:
    return R.shuffled_pairs(_pair_columns(s), s.seed).withColumn("item", _rank_text("pair"))


def _pair_columns(s: FeedSummary) -> DataFrame:
    return s.feed_stats.select(
        FEED, "provider", "country_code", "total_routes", "total_stops", "total_trips"
    )


def multimodal_view(s: FeedSummary) -> DataFrame:
    """Feeds with several modes as one text."""
    several = (
        s.feed_stats.withColumn("modes", F.size("by_type"))
        .where("modes > 1")
    )
    if s.multimodal_listed is not None:
        several = several.orderBy(FEED).limit(s.multimodal_listed)
    listed = F.array_sort(
        F.collect_list(F.struct(FEED, fill(W.MULTIMODAL_ENTRY).alias("text")))
    )
    return several.agg(
        F.array_join(F.transform(listed, lambda x: x["text"]), ", ").alias("names")
    )


def countries_view(s: FeedSummary) -> DataFrame:
    """All countries with their providers as one text: a list of the feeds."""
    listed = F.array_sort(
        F.collect_list(F.struct("country_code", fill(W.COUNTRY_ENTRY).alias("text")))
    )
    return S.providers_by_country(s.feeds).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(listed, lambda x: x["text"]), ". ").alias("listed"),
    )


def extremes_view(s: FeedSummary) -> DataFrame:
    first = R.top_feeds(s.feed_stats, "total_trips", 1).select(
        "provider", "country_code", F.col("total_trips").alias("total")
    )
    last = R.last_feed(s.feed_stats, "total_trips").select(
        F.col("provider").alias("last_provider"), F.col("total_trips").alias("last_total")
    )
    return beside(first, last)


def diverse_view(s: FeedSummary) -> DataFrame:
    return (
        s.feed_stats.withColumn("modes", F.size("by_type"))
        .orderBy(F.desc("modes"), FEED)
        .limit(1)
        .select("provider", "country_code", "modes", mode_names(F.col("by_type")).alias("mode_names"))
    )


def network_view(s: FeedSummary) -> DataFrame:
    """One row per feed with a provider and listed routes, for benchmark questions."""
    named = s.listed_routes.withColumn("name", _name())
    described = R.pick_one(
        s.listed_routes.where("route_short_name <> ''"), s.described_from, ["route_id"], s.seed
    ).select(
        FEED,
        F.col("route_short_name").alias("described_name"),
        route_type_name(F.coalesce("route_type", F.lit(3))).alias("described_mode"),
        F.col("trip_count").alias("described_trips"),
        F.col("stop_count").alias("described_stops"),
    )

    def best(metric: str, name: str, value: str) -> DataFrame:
        return R.best_route(named, metric).select(
            FEED, F.col("name").alias(name), F.col(metric).alias(value)
        )

    return (
        s.feed_stats.where("provider <> ''")
        .join(s.listed_routes.select(FEED).distinct(), FEED, "left_semi")
        .join(described, FEED, "left")
        .join(best("trip_count", "busiest_name", "busiest_trips"), FEED, "left")
        .join(best("stop_count", "widest_name", "widest_stops"), FEED, "left")
        .withColumn("mode_counts", modes_list(F.col("by_type"), W.MODE_COUNT_ENTRY, ", "))
        .withColumn("item", F.lit(""))
    )


def timetable_view(s: FeedSummary) -> DataFrame:
    """One scheduled route per feed with its span, headway and the feed's calendar."""
    route = R.pick_one(scheduled_routes(s.listed_routes), s.timetabled_from, ["route_id"], s.seed)
    first, last = F.col("first_departure"), F.col("last_departure")
    calendar = s.feed_stats.where("provider <> ''").select(
        FEED, "provider", "weekday_services", "weekend_services", "range_start", "range_end"
    )
    return (
        route.join(calendar, FEED)
        .withColumn("name", F.col("route_short_name"))
        .withColumn("span", service_span(first, last))
        .withColumn("span_hours", F.expr("span div 60"))
        .withColumns(_times_shown())
        .withColumn("headway", avg_headway(first, last, F.col("trip_count")))
        .withColumn("item", F.lit(""))
    )
