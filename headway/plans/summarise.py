"""Statistics of every feed: flat tables for joins, one nested document per feed."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators import summaries as S
from headway.operators.ranking import first_n_per_feed, sample_n
from headway.operators.schedules import route_schedules, routes_with_schedule
from headway.schema import FEED, POSITION
from headway.session import kept


# what is kept by FeedSummary.stored, later ones read earlier ones
STORED = (
    "route_stats", "listed_routes", "feed_stats", "agency", "sample_stops", "sample_transfers",
)

SQL_NAMES = {"agency": "agency_summary"}


@dataclass(frozen=True)
class FeedTables:
    """Cleaned tables of all feeds; ``feeds`` has feed_id, provider, country_code."""

    feeds: DataFrame
    agency: DataFrame
    routes: DataFrame
    trips: DataFrame
    stops: DataFrame
    stop_times: DataFrame
    calendar: DataFrame
    calendar_dates: DataFrame
    transfers: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def register(self) -> None:
        """Makes the tables known to Spark SQL under their names."""
        for name, table in self.as_dict().items():
            table.createOrReplaceTempView(name)


@dataclass(frozen=True)
class FeedSummary:
    """Lazy statistics of all feeds. ``stored`` keeps the shared ones.

    ``routes_listed`` and ``stations_listed`` keep the first rows of every feed only, in
    lists and in the facts drawn from them; None keeps all. Questions are asked about
    ``asked_routes``, ``asked_stops`` and ``asked_transfers`` of a feed. The route that is described and
    the one whose timetable is asked for are drawn from the first ``described_from`` and
    ``timetabled_from`` routes, by default from all. Texts list ``names_listed`` routes of a type,
    ``multimodal_listed`` feeds and ``context_routes`` routes of a feed; None lists all, which
    makes a text as long as the feed.
    """

    tables: FeedTables
    order: str = "text"
    scope: str = "all"
    missing: str = "blank"
    tie: tuple[str, ...] = (POSITION,)
    sampled_stops: int = S.SAMPLED_STOPS
    sampled_transfers: int = S.SAMPLED_TRANSFERS
    seed: int = 42
    routes_listed: int | None = None
    stations_listed: int | None = None
    asked_routes: int = 15
    asked_stops: int = 30
    asked_transfers: int = 15
    described_from: int | None = None
    timetabled_from: int | None = None
    names_listed: int = 15
    multimodal_listed: int | None = 8
    context_routes: int | None = 20

    @property
    def feeds(self) -> DataFrame:
        return self.tables.feeds

    @cached_property
    def agency(self) -> DataFrame:
        return S.agency_summary(self.tables.agency)

    @cached_property
    def route_stats(self) -> DataFrame:
        """All routes with their schedule statistics."""
        routes = self.tables.routes.select(
            FEED, "route_id", "route_short_name", "route_long_name", "route_type", "agency_id",
            POSITION,
        )
        schedules = route_schedules(
            self.tables.trips, self.tables.stop_times, self.order, self.tie
        )
        return routes_with_schedule(routes, schedules)

    @cached_property
    def listed_routes(self) -> DataFrame:
        """The routes of every feed that its summary lists and facts are drawn from."""
        if self.routes_listed is None:
            return self.route_stats
        return first_n_per_feed(self.route_stats, self.routes_listed)

    @cached_property
    def stations(self) -> DataFrame:
        return S.listed_stations(self.tables.stops, n=self.stations_listed)

    @cached_property
    def sample_stops(self) -> DataFrame:
        """Random stops of every feed, ranked in ``draw``."""
        return sample_n(
            self.tables.stops, self.sampled_stops, [FEED], ["stop_id"], self.seed, "draw"
        )

    @cached_property
    def sample_transfers(self) -> DataFrame:
        """Random transfers of every feed with stop names, ranked in ``draw``."""
        drawn = sample_n(
            self.tables.transfers, self.sampled_transfers, [FEED],
            ["from_stop_id", "to_stop_id"], self.seed, "draw",
        )
        return S.transfers_with_names(drawn, self.tables.stops, self.missing)

    @cached_property
    def calendar(self) -> DataFrame:
        return S.calendar_summary(self.tables.calendar, self.tables.calendar_dates)

    @cached_property
    def network(self) -> DataFrame:
        return S.network_stats(
            self.tables.routes, self.tables.stops, self.route_stats, self.scope
        )

    @cached_property
    def by_type(self) -> DataFrame:
        return S.code_map(S.routes_by_type(self.tables.routes), "route_type", "by_type")

    @cached_property
    def feed_stats(self) -> DataFrame:
        """One row per feed with all totals."""
        stations = F.count_if(F.col("location_type") == 1)
        if self.stations_listed is not None:
            stations = F.least(stations, F.lit(self.stations_listed))
        stops = self.tables.stops.groupBy(FEED).agg(stations.alias("station_count"))
        transfers = self.tables.transfers.groupBy(FEED).agg(
            F.count(F.lit(1)).alias("total_transfers")
        )
        zero = (
            "total_routes", "total_stops", "total_trips", "station_count", "total_transfers",
            "weekday_services", "weekend_services", "calendar_dates_count",
        )
        joined = (
            self.feeds.join(self.network, FEED, "left")
            .join(self.by_type, FEED, "left")
            .join(stops, FEED, "left")
            .join(transfers, FEED, "left")
            .join(self.calendar, FEED, "left")
        )
        empty = F.create_map().cast("map<int,bigint>")
        return (
            joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero})
            .withColumn("avg_stops_per_route", F.coalesce("avg_stops_per_route", F.lit(0.0)))
            .withColumn("avg_trips_per_route", F.coalesce("avg_trips_per_route", F.lit(0.0)))
            .withColumn("by_type", F.coalesce("by_type", empty))
        )

    def stored(self, *names: str) -> FeedSummary:
        """The same with shared statistics computed once and kept.

        These are the small results (a row per route or feed, or a sample); the scans of
        trips and stop times behind them then run once, however many views follow.
        """
        found = replace(self)
        for name in STORED:
            if not names or name in names:
                rows = getattr(found, name)
                same = name == "listed_routes" and rows is found.__dict__.get("route_stats")
                found.__dict__[name] = rows if same else kept(rows, name.replace("_", "-"))
        return found

    def register(self) -> None:
        """Makes the statistics known to Spark SQL, beside the tables."""
        self.tables.register()
        for name in STORED:
            getattr(self, name).createOrReplaceTempView(SQL_NAMES.get(name, name))

    def nested(self) -> DataFrame:
        """One document per feed, the lists cut as listed in the summaries."""

        def listed(df: DataFrame, order: str, name: str, columns: list[str]) -> DataFrame:
            rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *columns)))
            plain = F.transform(rows, lambda r: F.struct(*[r[c].alias(c) for c in columns]))
            return df.groupBy(FEED).agg(plain.alias(name))

        routes = S.route_summary(self.listed_routes).drop("agency_id").join(
            self.listed_routes.select(
                FEED, "route_id", POSITION, "agency_id", "trip_count", "stop_count",
                "first_departure", "last_departure", "headsigns",
            ),
            [FEED, "route_id"],
        )
        stops = S.stop_summary(self.sample_stops).join(
            self.sample_stops.select(FEED, "stop_id", "draw"), [FEED, "stop_id"]
        )
        location = S.code_map(
            S.stops_by_location_type(self.tables.stops), "location_type", "by_location_type"
        )
        parts = (
            listed(self.agency, POSITION, "agency", list(S.AGENCY_COLUMNS)),
            listed(routes, POSITION, "routes", [
                "route_id", "route_short_name", "route_long_name", "route_type", "agency_id",
                "trip_count", "stop_count", "first_departure", "last_departure", "headsigns",
            ]),
            listed(self.stations, POSITION, "stations",
                   ["stop_id", "stop_name", "stop_lat", "stop_lon"]),
            listed(stops, "draw", "sample_stops",
                   ["stop_id", "stop_name", "stop_lat", "stop_lon", "zone_id", "parent_station"]),
            listed(self.sample_transfers, "draw", "sample_transfers", [
                "from_stop_id", "from_stop_name", "to_stop_id", "to_stop_name",
                "transfer_type", "min_transfer_time",
            ]),
            location,
        )
        joined = self.feed_stats
        for part in parts:
            joined = joined.join(part, FEED, "left")
        return joined.select(
            FEED, "provider", "country_code", "agency",
            F.struct("total_routes", "by_type", "routes").alias("route_summary"),
            F.struct("total_stops", "by_location_type", "stations", "sample_stops").alias(
                "stop_summary"
            ),
            F.struct("total_transfers", "sample_transfers").alias("transfer_summary"),
            F.struct(
                "weekday_services", "weekend_services",
                F.when(
                    F.col("range_start").isNotNull(), F.array("range_start", "range_end")
                ).otherwise(F.array().cast("array<string>")).alias("date_range"),
                "calendar_dates_count",
            ).alias("calendar_summary"),
            F.struct(
                "total_routes", "total_stops", "total_trips",
                "avg_stops_per_route", "avg_trips_per_route",
            ).alias("network_stats"),
        )


def summarise_feeds(tables: FeedTables, **options) -> FeedSummary:
    return FeedSummary(tables, **options)
