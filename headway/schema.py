"""Canonical GTFS tables: columns, types, primary keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

FEED = "feed_id"

# place of a row in its feed's file: part of the file, then row within the part
POSITION = "_pos"
# raw rows a cleaned row stands for, and values of theirs that did not fit their type
COPIES, LOST = "_copies", "_lost"
# over how many tasks the rows of a feed's file are spread while copies are sought
SPREAD = "_spread"

POSITION_TYPE = T.StructType(
    [T.StructField("part", T.LongType()), T.StructField("row", T.LongType())]
)

# Column types of the GTFS reference, table by table; every other column is text.
COLUMN_TYPES = {
    "route_type": "smallint",
    "route_sort_order": "int",
    "direction_id": "tinyint",
    "wheelchair_accessible": "tinyint",
    "bikes_allowed": "tinyint",
    "stop_lat": "double",
    "stop_lon": "double",
    "location_type": "tinyint",
    "wheelchair_boarding": "tinyint",
    "stop_sequence": "int",
    "pickup_type": "tinyint",
    "drop_off_type": "tinyint",
    "shape_dist_traveled": "double",
    "timepoint": "tinyint",
    "monday": "tinyint",
    "tuesday": "tinyint",
    "wednesday": "tinyint",
    "thursday": "tinyint",
    "friday": "tinyint",
    "saturday": "tinyint",
    "sunday": "tinyint",
    "exception_type": "tinyint",
    "shape_pt_lat": "double",
    "shape_pt_lon": "double",
    "shape_pt_sequence": "int",
    "transfer_type": "tinyint",
    "min_transfer_time": "int",
    "headway_secs": "int",
    "exact_times": "tinyint",
}

_SPARK_TYPES = {
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


@dataclass(frozen=True)
class TableSpec:
    """One GTFS table; ``key`` is unique within a feed."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    required_file: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        return self.required + self.optional

    @property
    def file_name(self) -> str:
        return f"{self.name}.txt"

    def type_of(self, column: str) -> str:
        return COLUMN_TYPES.get(column, "string")

    @property
    def struct(self) -> T.StructType:
        """Schema of the cleaned table, led by the feed id."""
        fields = [T.StructField(FEED, T.StringType())]
        fields += [T.StructField(c, _SPARK_TYPES[self.type_of(c)]) for c in self.columns]
        return T.StructType(fields)


# The GTFS files read, their columns in canonical order and their keys.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "agency",
            required=("agency_id", "agency_name", "agency_url", "agency_timezone"),
            optional=("agency_lang", "agency_phone", "agency_fare_url", "agency_email"),
            key=("agency_id",),
            required_file=True,
        ),
        TableSpec(
            "routes",
            required=("route_id", "route_short_name", "route_long_name", "route_type"),
            optional=(
                "agency_id", "route_desc", "route_url", "route_color", "route_text_color",
                "route_sort_order",
            ),
            key=("route_id",),
            required_file=True,
        ),
        TableSpec(
            "trips",
            required=("route_id", "service_id", "trip_id"),
            optional=(
                "trip_headsign", "trip_short_name", "direction_id", "block_id", "shape_id",
                "wheelchair_accessible", "bikes_allowed",
            ),
            key=("trip_id",),
            required_file=True,
        ),
        TableSpec(
            "stops",
            required=("stop_id", "stop_name", "stop_lat", "stop_lon"),
            optional=(
                "stop_code", "stop_desc", "zone_id", "stop_url", "location_type",
                "parent_station", "stop_timezone", "wheelchair_boarding", "platform_code",
            ),
            key=("stop_id",),
            required_file=True,
        ),
        TableSpec(
            "stop_times",
            required=("trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"),
            optional=(
                "stop_headsign", "pickup_type", "drop_off_type", "shape_dist_traveled",
                "timepoint",
            ),
            key=("trip_id", "stop_sequence"),
            required_file=True,
        ),
        TableSpec(
            "calendar",
            required=(
                "service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday",
                "sunday", "start_date", "end_date",
            ),
            key=("service_id",),
        ),
        TableSpec(
            "calendar_dates",
            required=("service_id", "date", "exception_type"),
            key=("service_id", "date"),
        ),
        TableSpec(
            "shapes",
            required=("shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"),
            optional=("shape_dist_traveled",),
            key=("shape_id", "shape_pt_sequence"),
        ),
        TableSpec(
            "transfers",
            required=("from_stop_id", "to_stop_id"),
            optional=("transfer_type", "min_transfer_time"),
            key=("from_stop_id", "to_stop_id"),
        ),
        TableSpec(
            "frequencies",
            required=("trip_id", "start_time", "end_time", "headway_secs"),
            optional=("exact_times",),
            key=("trip_id", "start_time"),
        ),
        TableSpec(
            "feed_info",
            required=("feed_publisher_name", "feed_publisher_url", "feed_lang"),
            optional=(
                "feed_start_date", "feed_end_date", "feed_version", "feed_contact_email",
                "feed_contact_url", "default_lang",
            ),
        ),
    )
}

REQUIRED_FILES = tuple(s.file_name for s in TABLES.values() if s.required_file)
CALENDAR_FILES = ("calendar.txt", "calendar_dates.txt")

PAIR_FIELDS = ("instruction", "response", "category", "template_id", "feed_id", "provider")
PAIR_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in PAIR_FIELDS])

BENCHMARK_FIELDS = (
    "id", "question", "expected_answer", "scoring_criteria", "difficulty", "category",
)

SEED_FIELDS = (
    "feed_id", "provider", "country_code", "subdivision", "municipality",
    "download_url", "license_url", "status", "category", "selected_reason",
)
