"""What stands along a trip: gaps, distances, speeds, and the rules a timetable must keep."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.scalars import gtfs_seconds
from headway.operators.places import distance
from headway.schema import FEED

FASTEST = 100.0  # metres a second that no vehicle exceeds
LONG_GAP = 3600  # seconds between stops that part a trip into sessions
SOON = 600  # seconds ahead in which stops are counted


def trip_frames(
    stop_times: DataFrame,
    stops: DataFrame,
    tie: Sequence[str | Column] = ("stop_id",),
    gap: int = LONG_GAP,
    soon: int = SOON,
) -> DataFrame:
    """Every stop time with what lies between it and the one before on its trip.

    ``seconds`` is the arrival, or the departure where there is none. ``waited`` and ``metres`` reach
    back to the stop before, ``speed`` is their quotient, ``travelled`` the sum of metres so far,
    ``session`` counts the parts between gaps longer than ``gap``, and ``ahead`` the stops of the
    trip at most ``soon`` seconds later. Rows go by ``stop_sequence``, then by ``tie``. Unknown times and positions
    give NULL, and count nothing. All frames share one exchange by trip.
    """
    arrival = F.coalesce(gtfs_seconds(F.col("arrival_time")), gtfs_seconds(F.col("departure_time")))
    placed = stop_times.withColumn("seconds", arrival.cast("bigint")).join(
        stops.select(FEED, "stop_id", "stop_lat", "stop_lon"), [FEED, "stop_id"], "left"
    )
    trip = Window.partitionBy(FEED, "trip_id")
    line = trip.orderBy("stop_sequence", *tie)
    so_far = line.rowsBetween(Window.unboundedPreceding, 0)
    before = {c: F.lag(c).over(line) for c in ("seconds", "stop_lat", "stop_lon", "stop_sequence")}
    near = distance(before["stop_lat"], before["stop_lon"], F.col("stop_lat"), F.col("stop_lon"))
    rows = (
        placed.withColumn("before_sequence", before["stop_sequence"])
        .withColumn("waited", F.col("seconds") - before["seconds"])
        .withColumn("metres", near)
        .withColumn("_break", F.coalesce((F.col("waited") > gap).cast("int"), F.lit(0)))
    )
    timed = trip.orderBy("seconds").rangeBetween(1, soon)
    return (
        rows.withColumn("speed", F.when(F.col("waited") > 0, F.col("metres") / F.col("waited")))
        .withColumn("travelled", F.sum("metres").over(so_far))
        .withColumn("session", (F.sum("_break").over(so_far) + 1).cast("bigint"))
        .withColumn("ahead", F.when(F.col("seconds").isNotNull(), F.count("seconds").over(timed)))
        .drop("_break", "stop_lat", "stop_lon")
    )


def trip_problems(frames: DataFrame, fastest: float = FASTEST) -> DataFrame:
    """Per trip how often it breaks each rule (``feed_id, trip_id, stops`` and a count each)."""
    def count(condition: Column) -> Column:
        return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0))

    return frames.groupBy(FEED, "trip_id").agg(
        F.count(F.lit(1)).alias("stops"),
        count(F.col("waited") < 0).alias("times_fall_back"),
        count(F.col("stop_sequence") == F.col("before_sequence")).alias("repeated_sequence"),
        count(F.col("speed") > fastest).alias("too_fast"),
        F.coalesce(F.max("session"), F.lit(1)).cast("bigint").alias("sessions"),
        (F.coalesce(F.max("travelled"), F.lit(0.0)) / 1000).alias("kilometres"),
        F.max("waited").alias("longest_wait"),
    )


def _found(df: DataFrame, rule: str, broken: Column) -> DataFrame:
    return df.select(FEED, F.lit(rule).alias("rule"), broken.cast("bigint").alias("n"))


def timetable_rules(
    problems: DataFrame,
    tables: dict[str, DataFrame],
) -> DataFrame:
    """How many rows of a feed break each rule: ``feed_id, rule, broken, checked``.

    ``problems`` comes from ``trip_problems``; ``tables`` holds routes, trips, stops, calendar and
    transfers. A missing table leaves its rules out. Every table is read once, and broken rows are
    counted in the tasks before anything is exchanged.
    """
    parts = [
        _found(problems, "times_fall_back", F.col("times_fall_back") > 0),
        _found(problems, "repeated_sequence", F.col("repeated_sequence") > 0),
        _found(problems, "too_fast", F.col("too_fast") > 0),
        _found(problems, "single_stop", F.col("stops") == 1),
    ]
    if "stops" in tables:
        zero = (F.col("stop_lat") == 0) & (F.col("stop_lon") == 0)
        out = ~(F.col("stop_lat").between(-90, 90) & F.col("stop_lon").between(-180, 180))
        parts.append(_found(tables["stops"], "stop_at_zero", F.coalesce(zero, F.lit(False))))
        parts.append(_found(tables["stops"], "stop_off_the_globe", F.coalesce(out, F.lit(True))))
    if "routes" in tables:
        nameless = F.coalesce("route_short_name", F.lit("")) == ""
        nameless &= F.coalesce("route_long_name", F.lit("")) == ""
        parts.append(_found(tables["routes"], "route_without_name", nameless))
        if "trips" in tables:
            run = tables["trips"].select(FEED, "route_id").where("route_id is not null").distinct()
            known = tables["routes"].select(FEED, "route_id").join(
                run.withColumn("_run", F.lit(1)), [FEED, "route_id"], "left"
            )
            parts.append(_found(known, "route_without_trips", F.col("_run").isNull()))
    if "calendar" in tables:
        days = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
        idle = reduce(lambda a, b: a & b, [F.coalesce(F.col(d), F.lit(0)) != 1 for d in days])
        back = F.coalesce(F.col("end_date") < F.col("start_date"), F.lit(False))
        parts.append(_found(tables["calendar"], "service_on_no_day", idle))
        parts.append(_found(tables["calendar"], "service_ends_before_start", back))
    if "transfers" in tables:
        untimed = (F.col("transfer_type") == 2) & F.col("min_transfer_time").isNull()
        parts.append(
            _found(tables["transfers"], "transfer_without_time", F.coalesce(untimed, F.lit(False)))
        )
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(FEED, "rule").agg(F.sum("n").alias("broken"), F.count(F.lit(1)).alias("checked"))
