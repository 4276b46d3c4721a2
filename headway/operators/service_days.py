"""Days of service and the instants of departures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.scalars import gtfs_seconds
from headway.schema import FEED

# Columns of the calendar by day of the week, and the codes of an exception.
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
ADDED, REMOVED = 1, 2


def gtfs_date(c: Column) -> Column:
    """``20260131`` as a date; NULL for other texts."""
    return F.when(c.rlike(r"^\d{8}$"), F.try_to_date(c, "yyyyMMdd"))


def service_dates(calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """The dates each service runs on: ``feed_id, service_id, date``.

    Weekdays between start and end (both included), with the dates that exceptions add and
    without those they remove; of an addition and a removal on one date the removal counts. A
    service may be named by either table alone. Rows without a service, with a bad date or
    with an end before the start give no date.
    """
    runs = F.array(*[F.coalesce(F.col(d).cast("int"), F.lit(0)) for d in DAYS])
    spans = calendar.where("service_id is not null").select(
        FEED, "service_id", gtfs_date(F.col("start_date")).alias("_from"),
        gtfs_date(F.col("end_date")).alias("_to"), runs.alias("_runs"),
    )
    days = spans.where(F.col("_from") <= F.col("_to")).withColumn(
        "date", F.explode(F.sequence("_from", "_to"))
    )
    regular = days.where(F.get("_runs", F.weekday("date")) == 1).select(
        FEED, "service_id", "date", F.lit(0).alias("_exception")
    )
    exceptions = calendar_dates.where("service_id is not null").select(
        FEED, "service_id", gtfs_date(F.col("date")).alias("date"),
        F.col("exception_type").cast("int").alias("_exception"),
    ).where(F.col("date").isNotNull() & F.col("_exception").isin(ADDED, REMOVED))
    # one aggregation of both: a removal is the largest code
    return (
        regular.unionByName(exceptions)
        .groupBy(FEED, "service_id", "date").agg(F.max("_exception").alias("_last"))
        .where(F.col("_last") != REMOVED)
        .drop("_last")
    )


def instant(date: Column, seconds: Column, zone: Column) -> Column:
    """The instant of a time of a service day, as seconds since 1970 in UTC.

    Times count from noon minus twelve hours in the local zone, so on days when clocks
    change they count from 23:00 or 1:00, and midnight need not exist.
    """
    noon = F.to_utc_timestamp(date.cast("timestamp") + F.expr("interval 12 hours"), zone)
    return F.unix_timestamp(noon) - 12 * 3600 + seconds


def departure_instants(
    first_stops: DataFrame, trips: DataFrame, dates: DataFrame, zones: DataFrame
) -> DataFrame:
    """Every run of every trip: ``feed_id, trip_id, service_id, date, departure`` (seconds
    since 1970).

    ``first_stops`` holds a departure time per trip, ``zones`` a time zone per feed. Trips without
    a time, a service or a zone give no run. The session's time zone must be UTC.
    """
    timed = first_stops.select(
        FEED, "trip_id", gtfs_seconds(F.col("departure_time")).alias("_seconds")
    ).where("_seconds is not null")
    runs = (
        trips.where("service_id is not null").select(FEED, "trip_id", "service_id")
        .join(timed, [FEED, "trip_id"])
        .join(zones.where("time_zone is not null").select(FEED, "time_zone"), FEED)
    )
    # trips of a service stand beside its dates; a service is never one task's: the join by
    # feed and service is split where it is hot
    return runs.join(dates, [FEED, "service_id"]).select(
        FEED, "trip_id", "service_id", "date",
        instant(F.col("date"), F.col("_seconds"), F.col("time_zone")).cast("bigint").alias("departure"),
    )


def runs_per_day(runs: DataFrame, zones: DataFrame) -> DataFrame:
    """Departures per feed and civil day of its zone, which differs from the service day
    for times past 24 o'clock."""
    local = F.from_utc_timestamp(F.timestamp_seconds("departure"), F.col("time_zone"))
    return (
        runs.join(zones, FEED)
        .groupBy(FEED, F.to_date(local).alias("day"))
        .agg(F.count(F.lit(1)).alias("runs"), F.countDistinct("service_id").alias("services"))
    )
