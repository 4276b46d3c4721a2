"""Trips, stop times and the schedule statistics of routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.scalars import gtfs_seconds, stripped
from headway.operators.ranking import first_n
from headway.schema import FEED, POSITION

# key of grouping, sorting and joining: what tells most rows apart stands first, because
# Spark's sorts compare the first bytes of the first column before whole rows
ROUTE = ["route_id", FEED]

EARLY_BEFORE = "06:00"
LATE_AFTER = "23:00"


def first_stop_per_trip(
    stop_times: DataFrame, tie: Sequence[str | Column] = (POSITION,)
) -> DataFrame:
    """The row with the least stop sequence of every trip.

    Rows without a sequence are no candidates; equal sequences go by ``tie``.
    """
    known = stop_times.where("trip_id is not null and stop_sequence is not null")
    return first_n(known, 1, [FEED, "trip_id"], ["stop_sequence", *tie]).drop("_rank")


def stop_times_with_route(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Stop times of known trips that have a route."""
    routed = trips.where("trip_id is not null and route_id is not null").select(
        FEED, "trip_id", "route_id"
    )
    return stop_times.join(routed, [FEED, "trip_id"])


def route_visits(
    trips: DataFrame,
    stop_times: DataFrame,
    order: str = "text",
    tie: Sequence[str] = (POSITION,),
    approximate: bool = False,
) -> DataFrame:
    """Per route its distinct stops, and first and last of the departures from the trips'
    first stops.

    ``order="text"`` compares times as text, where ``9:00:00`` lies behind
    ``25:10:00``; ``order="seconds"`` as times.
    """
    # one row per trip before the join, combined ahead of the only shuffle of stop times;
    # the set is bounded by the stops of a trip
    placed = F.when(F.col("stop_sequence").isNotNull(), F.struct("stop_sequence", *tie))
    calls = (
        stop_times.where("trip_id is not null")
        .groupBy(FEED, "trip_id")
        .agg(
            F.min_by("departure_time", placed).alias("departure"),
            F.collect_set("stop_id").alias("stops"),
        )
    )
    visits = stop_times_with_route(calls, trips).select(
        FEED, "route_id", "departure", F.posexplode_outer("stops").alias("place", "stop_id")
    )
    # a departure counts once per trip, beside the first of its stops
    once = (F.coalesce("place", F.lit(0)) == 0) & (stripped(F.col("departure")) != "")
    departure = F.when(once, F.col("departure"))
    if order == "seconds":
        at = gtfs_seconds(departure)
        first, last = F.min_by(departure, at), F.max_by(departure, at)
    else:
        first, last = F.min(departure), F.max(departure)
    count = F.approx_count_distinct if approximate else F.count_distinct
    found = visits.groupBy(*ROUTE).agg(
        count(F.col("stop_id")).alias("stop_count"),
        first.alias("first_departure"),
        last.alias("last_departure"),
    )
    return found.select(FEED, "route_id", "stop_count", "first_departure", "last_departure")


def route_trip_counts(trips: DataFrame) -> DataFrame:
    return (
        trips.where("route_id is not null")
        .groupBy(*ROUTE)
        .agg(F.count_distinct("trip_id").alias("trip_count"))
        .select(FEED, "route_id", "trip_count")
    )


def route_headsigns(trips: DataFrame, n: int = 5) -> DataFrame:
    """The first n distinct headsigns of a route in text order."""
    shown = (
        trips.where("route_id is not null and trip_id is not null and trip_headsign is not null")
        .select(FEED, "route_id", "trip_headsign")
        .distinct()
    )
    few = first_n(shown, n, ROUTE, ["trip_headsign"])
    listed = F.array_sort(F.collect_list("trip_headsign")).alias("headsigns")
    return few.groupBy(*ROUTE).agg(listed).select(FEED, "route_id", "headsigns")


def route_schedules(
    trips: DataFrame,
    stop_times: DataFrame,
    order: str = "text",
    tie: Sequence[str] = (POSITION,),
    approximate: bool = False,
) -> DataFrame:
    """Schedule statistics of every route that has trips.

    ``feed_id, route_id, trip_count, stop_count, first_departure, last_departure,
    headsigns``. The three parts are aggregated to route level on their own, each with a
    single distinct aggregate at most, and then joined on the key they are already
    partitioned by. Stop times are read and shuffled once.
    """
    found = (
        route_trip_counts(trips)
        .join(route_visits(trips, stop_times, order, tie, approximate), ROUTE, "left")
        .join(route_headsigns(trips), ROUTE, "left")
    )
    return (
        found.select(FEED, "route_id", *[c for c in found.columns if c not in ROUTE])
        .withColumn("stop_count", F.coalesce("stop_count", F.lit(0)))
        .withColumn("headsigns", F.coalesce("headsigns", F.array().cast("array<string>")))
    )


def routes_with_schedule(routes: DataFrame, schedules: DataFrame) -> DataFrame:
    """All routes, with zero counts where no trip runs."""
    joined = routes.join(schedules, ROUTE, "left")
    return (
        joined.select(FEED, "route_id", *[c for c in joined.columns if c not in ROUTE])
        .withColumn("trip_count", F.coalesce("trip_count", F.lit(0)))
        .withColumn("stop_count", F.coalesce("stop_count", F.lit(0)))
        .withColumn("headsigns", F.coalesce("headsigns", F.array().cast("array<string>")))
    )


def _given(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) != ""


def scheduled_routes(route_stats: DataFrame, need_names: bool = True) -> DataFrame:
    """Routes with schedule data.

    With ``need_names``: both departures and a short name; otherwise a first departure
    and at least one trip.
    """
    if need_names:
        return route_stats.where(
            _given("first_departure") & _given("last_departure") & _given("route_short_name")
        )
    return route_stats.where(_given("first_departure") & (F.col("trip_count") > 0))


def early_routes(
    route_stats: DataFrame, before: str = EARLY_BEFORE, order: str = "text"
) -> DataFrame:
    if order == "seconds":
        return route_stats.where(
            gtfs_seconds(F.col("first_departure")) < gtfs_seconds(F.lit(before + ":00"))
        )
    return route_stats.where(F.col("first_departure") < before)


def late_routes(
    route_stats: DataFrame, after: str = LATE_AFTER, order: str = "text"
) -> DataFrame:
    if order == "seconds":
        return route_stats.where(
            gtfs_seconds(F.col("last_departure")) > gtfs_seconds(F.lit(after + ":00"))
        )
    return route_stats.where(F.col("last_departure") > after)


def routes_of_type(routes: DataFrame, route_type: int) -> DataFrame:
    return routes.where(F.col("route_type") == route_type)
