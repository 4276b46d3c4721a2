"""Headways summarised by mergeable sketches, from stops up to the network.

A sketch of each stop and route is made once per feed and stored; those of routes, feeds and the
network are merged from them, so a new feed costs only its own rows. Quantile sketches (KLL) hold a
bounded number of values whatever they stand for; counts of different stops use HyperLogLog.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.scalars import gtfs_seconds
from headway.schema import FEED

LEVELS = {
    "stop": (FEED, "route_id", "stop_id"),
    "route": (FEED, "route_id"),
    "feed": (FEED,),
    "network": (),
}
QUANTILES = (0.1, 0.5, 0.9)
SIZE = 400  # of a KLL sketch: rank errors of about 0.7 %
# Of the rank that a sketch of this size tells, with 99 % confidence.
RANK_ERROR = 0.02


def headways(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Seconds between departures that follow each other at a stop of a route."""
    timed = stop_times.select(
        FEED, "trip_id", "stop_id", gtfs_seconds(F.col("departure_time")).cast("bigint").alias("at")
    ).where("at is not null")
    routed = timed.join(trips.where("route_id is not null").select(FEED, "trip_id", "route_id"), [FEED, "trip_id"])
    line = Window.partitionBy(FEED, "route_id", "stop_id").orderBy("at", "trip_id")
    return routed.withColumn("headway", F.col("at") - F.lag("at").over(line)).where(
        "headway is not null"
    ).select(FEED, "route_id", "stop_id", "headway")


def stop_sketches(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """One sketch per feed, route and stop, the rows that are stored."""
    return rows.groupBy(*LEVELS["stop"]).agg(
        F.kll_sketch_agg_bigint("headway", F.lit(size)).alias("headways"),
        F.hll_sketch_agg("stop_id", F.lit(12)).alias("stops"),
        F.count(F.lit(1)).alias("n"),
        F.min("headway").alias("least"),
        F.max("headway").alias("most"),
    )


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches merged by fewer columns; a merge of merged ones gives the same counts."""
    return sketches.groupBy(*by).agg(
        F.kll_merge_agg_bigint("headways").alias("headways"),
        F.hll_union_agg("stops").alias("stops"),
        F.sum("n").alias("n"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )


def quantiles(sketches: DataFrame, by: Sequence[str], at: Sequence[float] = QUANTILES) -> DataFrame:
    """Per group: n, least and most exactly, quantiles and the number of stops about."""
    return sketches.select(
        *by, "n", "least", "most",
        *[F.kll_sketch_get_quantile_bigint("headways", F.lit(q)).alias(f"p{round(q * 100)}") for q in at],
        F.hll_sketch_estimate("stops").alias("stops"),
    )
