"""Feed-level counts, calendars, transfers and network statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.scalars import blank
from headway.operators.ranking import first_n_per_feed
from headway.schema import FEED, POSITION

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday")
WEEKEND = ("saturday", "sunday")

AGENCY_COLUMNS = ("agency_id", "agency_name", "agency_url", "agency_timezone")

# Rows listed in a feed summary.
LISTED_ROUTES = 50
SAMPLED_STOPS = 100
SAMPLED_TRANSFERS = 50


def _blank_text(df: DataFrame, columns: list[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(
        *[blank(F.col(c)).alias(c) if kinds[c] == "string" else F.col(c) for c in columns]
    )


def agency_summary(agency: DataFrame) -> DataFrame:
    """Agencies as listed in a summary, NULL text as blank, with their file position."""
    carried = [POSITION] if POSITION in agency.columns else []
    return _blank_text(agency, [FEED, *AGENCY_COLUMNS, *carried])


def route_summary(routes: DataFrame) -> DataFrame:
    return _blank_text(
        routes,
        [FEED, "route_id", "route_short_name", "route_long_name", "route_type", "agency_id"],
    )


def stop_summary(stops: DataFrame) -> DataFrame:
    return _blank_text(
        stops,
        [FEED, "stop_id", "stop_name", "stop_lat", "stop_lon", "zone_id", "parent_station"],
    )


def stations(stops: DataFrame) -> DataFrame:
    return stops.where("location_type = 1")


def listed_stations(stops: DataFrame, order=(POSITION,), n: int | None = None) -> DataFrame:
    """The stations of every feed, with ``n`` the first of them only."""
    return stations(stops) if n is None else first_n_per_feed(stations(stops), n, order)


def counts_by_code(df: DataFrame, code: str) -> DataFrame:
    """Rows per feed and integer code, rows without a code left out."""
    return (
        df.where(F.col(code).isNotNull())
        .groupBy(FEED, F.col(code).cast("int").alias(code))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def routes_by_type(routes: DataFrame) -> DataFrame:
    return counts_by_code(routes, "route_type")


def stops_by_location_type(stops: DataFrame) -> DataFrame:
    return counts_by_code(stops, "location_type")


def code_map(counts: DataFrame, code: str, name: str) -> DataFrame:
    """Counts per code as one map per feed; a code has at most 16 bits."""
    entries = F.array_sort(F.collect_list(F.struct(code, "n")))
    return counts.groupBy(FEED).agg(F.map_from_entries(entries).alias(name))


def modes_per_feed(routes: DataFrame) -> DataFrame:
    """Number of distinct route types per feed."""
    return routes.groupBy(FEED).agg(F.count_distinct("route_type").alias("modes"))


def multimodal(routes: DataFrame) -> DataFrame:
    return modes_per_feed(routes).where("modes > 1")


def most_diverse_feed(routes: DataFrame) -> DataFrame:
    """The feed with the most route types, the first feed on a tie."""
    return modes_per_feed(routes).orderBy(F.desc("modes"), FEED).limit(1)


def _runs_on(days: tuple[str, ...]) -> Column:
    """Any day flag is 1; an unknown flag counts as no."""
    flags = [F.coalesce(F.col(d) == 1, F.lit(False)) for d in days]
    result = flags[0]
    for flag in flags[1:]:
        result = result | flag
    return result


def calendar_summary(calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """Weekday and weekend services, the date range and the number of exceptions.

    The range of the exception dates stands in where the calendar gives none.
    """
    regular = calendar.groupBy(FEED).agg(
        F.count_if(_runs_on(WEEKDAYS)).alias("weekday_services"),
        F.count_if(_runs_on(WEEKEND)).alias("weekend_services"),
        F.min("start_date").alias("_from"),
        F.max("end_date").alias("_to"),
    )
    exceptions = calendar_dates.groupBy(FEED).agg(
        F.count(F.lit(1)).alias("calendar_dates_count"),
        F.min("date").alias("_first"),
        F.max("date").alias("_last"),
    )
    ranged = F.col("_from").isNotNull() & F.col("_to").isNotNull()
    return regular.join(exceptions, FEED, "full").select(
        FEED,
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("weekday_services", "weekend_services", "calendar_dates_count")
        ],
        F.when(ranged, F.col("_from")).otherwise(F.col("_first")).alias("range_start"),
        F.when(ranged, F.col("_to")).otherwise(F.col("_last")).alias("range_end"),
    )


def transfers_with_names(
    transfers: DataFrame, stops: DataFrame, missing: str = "blank"
) -> DataFrame:
    """Transfers with the names of both stops.

    An unknown stop is shown blank or, with ``missing="id"``, by its id.
    """

    def names(side: str) -> DataFrame:
        return stops.select(
            FEED, F.col("stop_id").alias(f"{side}_stop_id"), F.col("stop_name").alias(f"{side}_name")
        )

    def shown(side: str) -> Column:
        other = F.lit("") if missing == "blank" else F.col(f"{side}_stop_id")
        return F.coalesce(F.col(f"{side}_name"), other).alias(f"{side}_stop_name")

    named = transfers.join(names("from"), [FEED, "from_stop_id"], "left").join(
        names("to"), [FEED, "to_stop_id"], "left"
    )
    rest = [c for c in transfers.columns if c not in (FEED, "from_stop_id", "to_stop_id")]
    return named.select(
        FEED, "from_stop_id", shown("from"), "to_stop_id", shown("to"), *rest
    )


def network_stats(
    routes: DataFrame,
    stops: DataFrame,
    route_stats: DataFrame,
    scope: str = "all",
    order=(POSITION,),
) -> DataFrame:
    """Totals and averages per feed.

    ``scope="all"`` counts the trips of all routes; ``scope="listed"`` those of the
    first 50 routes only, while still dividing by the number of all routes.
    """
    counted = route_stats if scope == "all" else first_n_per_feed(route_stats, LISTED_ROUTES, order)

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(FEED).agg(F.count(F.lit(1)).alias(name))

    trips = counted.groupBy(FEED).agg(F.sum("trip_count").alias("total_trips"))
    totals = (
        rows(routes, "total_routes")
        .join(rows(stops, "total_stops"), FEED, "full")
        .join(trips, FEED, "full")
    )
    totals = totals.select(
        FEED,
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("total_routes", "total_stops", "total_trips")
        ],
    )

    def average(total: str, name: str) -> Column:
        share = F.try_divide(F.col(total), F.col("total_routes"))
        return F.round(F.coalesce(share, F.lit(0.0)), 1).alias(name)

    return totals.select(
        "*",
        average("total_stops", "avg_stops_per_route"),
        average("total_trips", "avg_trips_per_route"),
    )


def providers_by_country(feeds: DataFrame) -> DataFrame:
    """The providers of every country in feed order, countries without a code left out.

    The list is the result; ``feeds`` has one row per archive.
    """
    listed = F.array_sort(F.collect_list(F.struct(FEED, "provider")))
    return (
        feeds.where("country_code <> ''")
        .groupBy("country_code")
        .agg(F.array_join(F.transform(listed, lambda x: x["provider"]), ", ").alias("providers"))
    )


def only_feeds(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the requested feeds (``ids``: one column ``feed_id``)."""
    return df.join(ids.select(FEED).distinct(), FEED, "left_semi")


def missing_entries(df: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Adds the entries of one array column another lacks, in text order."""
    return df.withColumn(name, F.array_sort(F.array_except(left, right)))


def shared_entries(df: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Adds the entries two array columns have in common, in text order."""
    return df.withColumn(name, F.array_sort(F.array_intersect(left, right)))


def missing_keys(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of one table another lacks."""
    return left.subtract(right)


def shared_keys(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows two tables have in common."""
    return left.intersect(right)
