"""Transit tables read out of the TPC-H-like tables.

``Bound`` gives them as DataFrames, ``headway.bindings.oracle`` as SQL; both must say
the same. Feeds are regions, routes customers, trips orders, stops suppliers, stop times
line items.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.scalars import fill, route_type_name
from headway.plans.summarise import FeedSummary, FeedTables

# stop times repeat their key, so equal sequences go by the remaining columns
TIE = ("stop_id", "departure_time")
SEGMENT_TYPES = {"BUILDING": 3, "AUTOMOBILE": 1, "MACHINERY": 0, "HOUSEHOLD": 99}


class Bound:
    """The transit views over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def feeds(self) -> DataFrame:
        return self.raw("region").selectExpr(
            "string(r_regionkey) as feed_id",
            "r_name as provider",
            "substr(r_name, 1, 2) as country_code",
        )

    @cached_property
    def agency(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            "string(n_regionkey) as feed_id",
            "string(n_nationkey) as agency_id",
            "n_name as agency_name",
            "concat('http://', lower(n_name), '.example') as agency_url",
            "case when n_nationkey % 5 <> 0 then concat('Etc/', n_name) end as agency_timezone",
            "n_nationkey as _pos",
        )

    @cached_property
    def routes(self) -> DataFrame:
        kinds = " ".join(f"when '{s}' then {t}" for s, t in SEGMENT_TYPES.items())
        nation = self.raw("nation").selectExpr("n_nationkey", "n_regionkey")
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "string(n_regionkey) as feed_id",
                "string(c_custkey) as route_id",
                "case when c_custkey % 7 <> 0 then c_name end as route_short_name",
                "case when c_acctbal >= 2000 then concat(c_mktsegment, ' line') end"
                " as route_long_name",
                f"smallint(case c_mktsegment {kinds} end) as route_type",
                "string(c_nationkey) as agency_id",
                "c_custkey as _pos",
            )
        )

    @cached_property
    def trips(self) -> DataFrame:
        return (
            self.raw("orders")
            .join(self.routes.select("feed_id", "_pos"), F.col("o_custkey") == F.col("_pos"))
            .selectExpr(
                "feed_id",
                "string(o_orderkey) as trip_id",
                "string(o_custkey) as route_id",
                "concat(o_orderpriority, '/', date_format(o_orderdate, 'yyyyMM')) as service_id",
                "case when o_totalprice >= 5000 then concat(o_orderstatus, ' ', o_orderpriority)"
                " end as trip_headsign",
                "o_orderkey as _pos",
            )
        )

    @cached_property
    def stops(self) -> DataFrame:
        nation = self.raw("nation").selectExpr("n_nationkey", "n_regionkey")
        return (
            self.raw("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "string(n_regionkey) as feed_id",
                "string(s_suppkey) as stop_id",
                "s_name as stop_name",
                "s_acctbal / 100 as stop_lat",
                "s_acctbal / -50 as stop_lon",
                "string(s_nationkey) as zone_id",
                "tinyint(case when s_suppkey % 11 <> 0 then s_suppkey % 3 end) as location_type",
                "cast(null as string) as parent_station",
                "s_suppkey as _pos",
            )
        )

    @cached_property
    def timed(self) -> DataFrame:
        """Line items as stop times, by the number of their order."""
        # hours pass 24; those of closed lines are unpadded; some departures are blank
        hour, minute = "int(l_quantity) % 28", "int(l_extendedprice) % 60"
        return self.raw("lineitem").selectExpr(
            "l_orderkey",
            "l_suppkey",
            "l_linenumber",
            f"concat(if(l_linestatus = 'O' and {hour} < 10, '0', ''), {hour},"
            f" if({minute} < 10, ':0', ':'), {minute}, ':00') as time",
            "case when l_discount = 0 then if(l_returnflag = 'R', 'none', 'blank') end as gap",
        )

    @cached_property
    def stop_times(self) -> DataFrame:
        return self.timed.join(
            self.trips.select("feed_id", "_pos"), F.col("l_orderkey") == F.col("_pos")
        ).selectExpr(
            "feed_id",
            "string(l_orderkey) as trip_id",
            "l_linenumber as stop_sequence",
            "string(l_suppkey) as stop_id",
            "time as arrival_time",
            "case when gap is null then time when gap = 'blank' then '' end as departure_time",
        )

    @cached_property
    def _dated(self) -> DataFrame:
        """Orders with the service and date they stand for."""
        return (
            self.raw("orders")
            .join(self.routes.select("feed_id", "_pos"), F.col("o_custkey") == F.col("_pos"))
            .selectExpr(
                "feed_id",
                "o_orderkey",
                "o_orderstatus",
                "concat(o_orderpriority, '/', date_format(o_orderdate, 'yyyyMM')) as service_id",
                "date_format(o_orderdate, 'yyyyMMdd') as date",
                "weekday(o_orderdate) as day",
            )
        )

    @cached_property
    def calendar(self) -> DataFrame:
        days = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
        # the last feed has calendar_dates only
        return (
            self._dated.where("feed_id <> '4'")
            .groupBy("feed_id", "service_id")
            .agg(
                *[F.expr(f"tinyint(max(int(day = {i})))").alias(d) for i, d in enumerate(days)],
                F.min("date").alias("start_date"),
                F.max("date").alias("end_date"),
            )
        )

    @cached_property
    def calendar_dates(self) -> DataFrame:
        return (
            self._dated.where("o_orderstatus = 'F'")
            .groupBy("feed_id", "service_id", "date")
            .agg(F.expr("tinyint(1 + min(o_orderkey) % 2)").alias("exception_type"))
        )

    @cached_property
    def transfers(self) -> DataFrame:
        following = (
            "lead(l_suppkey) over (partition by l_orderkey order by l_linenumber, l_suppkey)"
        )
        kind = "(from_key + to_key) % 6"
        return (
            self.raw("lineitem")
            .selectExpr("l_orderkey", "l_suppkey as from_key", f"{following} as to_key")
            .where("to_key is not null")
            .join(self.trips.select("feed_id", "_pos"), F.col("l_orderkey") == F.col("_pos"))
            .select("feed_id", "from_key", "to_key")
            .distinct()
            .selectExpr(
                "feed_id",
                "string(from_key) as from_stop_id",
                "string(to_key) as to_stop_id",
                f"tinyint(case when {kind} < 5 then {kind} end) as transfer_type",
                f"int(case when {kind} = 2 then from_key % 7 * 90 end) as min_transfer_time",
            )
        )

    @cached_property
    def tables(self) -> FeedTables:
        return FeedTables(
            self.feeds, self.agency, self.routes, self.trips, self.stops, self.stop_times,
            self.calendar, self.calendar_dates, self.transfers,
        )

    @cached_property
    def summary(self) -> FeedSummary:
        return FeedSummary(self.tables, tie=TIE)

    @cached_property
    def listed(self) -> FeedSummary:
        """The summary with route statistics stored, for views that read them twice."""
        return self.summary.stored("route_stats", "listed_routes")

    @cached_property
    def kept(self) -> FeedSummary:
        """The summary with route and feed statistics stored, for views that repeat them."""
        return self.summary.stored("route_stats", "listed_routes", "feed_stats")

    @cached_property
    def raw_routes(self) -> DataFrame:
        """Routes as read from a feed: all text, other column order, extra columns."""
        nation = self.raw("nation").selectExpr("n_nationkey", "n_regionkey")
        sort_order = (
            "case c_custkey % 8 when 0 then '1.0' when 1 then '1.5' when 2 then 'x'"
            " when 3 then '-2' when 4 then '99999999999' when 5 then ''"
            " when 6 then ' 12 ' else string(c_custkey) end"
        )
        kinds = " ".join(f"when '{s}' then '{t}'" for s, t in SEGMENT_TYPES.items())
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "c_mktsegment as segment",
                f"{sort_order} as route_sort_order",
                f"case c_mktsegment {kinds} else '70000' end as route_type",
                "c_name as route_short_name",
                "string(c_custkey) as route_id",
                "string(n_regionkey) as feed_id",
            )
        )

    @cached_property
    def catalog(self) -> DataFrame:
        """A catalog of feeds, one entry per customer."""
        nation = self.raw("nation")
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "c_custkey as mdb_source_id",
                "if(c_mktsegment = 'MACHINERY', 'gtfs-rt', 'gtfs') as data_type",
                "case c_custkey % 4 when 0 then 'active' when 1 then 'inactive'"
                " when 2 then 'deprecated' end as status",
                "case when c_custkey % 31 <> 0 then c_name end as provider",
                "case when c_custkey % 13 <> 0 then n_name end as country_code",
                "concat('S', n_regionkey) as subdivision_name",
                "cast(null as string) as municipality",
                "case when c_custkey % 9 = 0 then null when c_custkey % 10 = 0 then ''"
                " else concat('http://feeds.example/', c_custkey, '.zip') end as direct_download",
                "case c_custkey % 5 when 0 then 0 when 1 then 1 when 2 then 2 end"
                " as authentication_type",
                "cast(null as string) as license",
            )
        )

    @cached_property
    def pairs(self) -> DataFrame:
        """Question/answer pairs: user turns with the assistant's reply, and documents.

        ``record`` identifies a pair. Documents have copies, so instructions repeat.
        """
        reply = "lead({}) over (partition by conv_id order by turn)"
        turns = (
            self.raw("conversations")
            .selectExpr(
                "conv_id", "turn", "role", "text",
                f"{reply.format('role')} as next_role",
                f"{reply.format('text')} as reply",
            )
            .where("role = 'user' and next_role = 'assistant'")
            .selectExpr(
                "conv_id * 100 + turn as record",
                "text as instruction",
                "reply as response",
                "case conv_id % 6 when 0 then 'agency_overview' when 1 then 'route_info'"
                " when 2 then 'schedule' when 3 then 'stop_info' when 4 then 'network_stats'"
                " end as category",
                "concat('turn_', turn) as template_id",
                "string(conv_id % 7) as feed_id",
                "cast(null as string) as provider",
            )
        )
        documents = self.raw("documents").selectExpr(
            "-1 - doc_id as record",
            "text as instruction",
            "case when doc_id % 50 = 0 then ' ' when doc_id % 50 = 1 then lang"
            " else concat(source, ' holds a text in ', lang) end as response",
            "source as category",
            "case when doc_id % 17 <> 0 then lang end as template_id",
            "case when doc_id % 3 = 0 then '' else string(doc_id % 5) end as feed_id",
            "source as provider",
        )
        return turns.unionByName(documents)

    @cached_property
    def answers(self) -> DataFrame:
        """Benchmark items on all routes with a predicted answer to each."""
        stats = (
            self.summary.route_stats.join(self.feeds, "feed_id")
            .withColumn("mode", F.coalesce(route_type_name(F.col("route_type")), F.lit("transit")))
        )
        return stats.select(
            F.concat("feed_id", F.lit("-"), "route_id").alias("id"),
            fill("Describe route {route_id} operated by {provider}.").alias("question"),
            fill(
                "Route {route_id} is a {mode} service by {provider} with approximately"
                " {trip_count} trips serving {stop_count} stops."
            ).alias("expected_answer"),
            F.when(
                F.col("trip_count") % 3 == 0,
                fill(
                    "Must mention at least 2 of: {mode} service, trip count ({trip_count}),"
                    " {provider} and stops"
                ),
            )
            .when(F.col("trip_count") % 3 == 1, fill("Must state: {trip_count} trips, {mode} or"
                  " (transit) and {stop_count} stops"))
            .otherwise("")
            .alias("scoring_criteria"),
            F.when(F.col("trip_count") < 8, "easy").when(F.col("trip_count") < 12, "medium").alias(
                "difficulty"
            ),
            F.col("mode").alias("category"),
            F.when(
                F.col("trip_count") == 0, ""
            ).otherwise(
                fill(
                    "Route {route_id} by {provider} runs {trip_count} trips. Service starts at"
                    " {first_departure} and ends at {last_departure}."
                )
            ).alias("generated"),
        )

    @cached_property
    def scored(self) -> DataFrame:
        """Scored answers, one per event."""
        return self.raw("events").selectExpr(
            "string(event_id) as id",
            "event_type as category",
            "case user_id % 4 when 0 then 'easy' when 1 then 'medium' when 2 then 'hard' end"
            " as difficulty",
            "event_id % 1000 / 1000 as rouge_l",
            "user_id % 5 / 4 as keyword_match",
            "user_id % 3 / 2 as criteria_match",
        )
