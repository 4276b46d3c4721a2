"""Queries on tables: catalog, cleaning, integrity, statistics, ranking."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from headway.bindings import oracle as O
from headway.bindings.oracle import with_stats, with_views
from headway.bindings.registry import query
from headway.bindings.views import TIE
from headway.operators import catalog as C
from headway.operators import cleaning as K
from headway.operators import integrity as I
from headway.operators import ranking as R
from headway.operators import schedules as S
from headway.operators import summaries as M
from headway.schema import TABLES
from headway.session import shared_folder
from headway.sources import documents as J
from headway.sources import lake
from headway.sources.catalog import read_catalog


def text(c: str):
    """An array column as one text, so that results compare as plain values."""
    return F.array_join(c, "|").alias(c)


# --- catalog -----------------------------------------------------------------------

USABLE = """data_type = 'gtfs' AND status IS DISTINCT FROM 'inactive'
    AND direct_download <> '' AND coalesce(authentication_type, 0) = 0"""


@query(
    "catalog_round_trip",
    with_views("""
        SELECT mdb_source_id, provider, status, country_code,
               nullif(direct_download, '') AS direct_download FROM catalog"""),
)
def _(b):
    folder = f"{shared_folder(b.spark)}/catalog-{uuid.uuid4().hex}"
    dotted = {"country_code": "location.country_code", "direct_download": "urls.direct_download"}
    named = b.catalog.withColumnsRenamed(dotted)
    named.write.option("header", "true").csv(folder)
    return read_catalog(b.spark, folder).select(
        "mdb_source_id", "provider", "status", "country_code", "direct_download"
    )


@query("usable_feeds", with_views(f"SELECT mdb_source_id, status FROM catalog WHERE {USABLE}"))
def _(b):
    return C.usable_feeds(b.catalog).select("mdb_source_id", "status")


@query(
    "active_feeds",
    with_views("""
        SELECT mdb_source_id, provider FROM catalog
        WHERE data_type = 'gtfs' AND status = 'active' AND direct_download IS NOT NULL
          AND authentication_type IS NULL"""),
)
def _(b):
    return C.active_feeds(b.catalog).select("mdb_source_id", "provider")


@query(
    "provider_search",
    with_views("""
        SELECT mdb_source_id, provider, country_code FROM catalog
        WHERE regexp_matches(provider, 'customer#0+[1-7]\\d*5$', 'i')
          AND country_code = 'NATION_7'"""),
)
def _(b):
    return C.provider_search(b.catalog, r"customer#0+[1-7]\d*5$", "NATION_7").select(
        "mdb_source_id", "provider", "country_code"
    )


@query(
    "feeds_in_region",
    with_views("""
        SELECT mdb_source_id, CASE WHEN country_code IN ('NATION_1', 'NATION_2') THEN 'north'
                                   ELSE 'south' END AS region
        FROM catalog WHERE country_code IN ('NATION_1', 'NATION_2', 'NATION_20')"""),
)
def _(b):
    regions = {"north": ["NATION_1", "NATION_2"], "south": ["NATION_20"]}
    return C.feeds_in_region(b.catalog, regions).select("mdb_source_id", "region")


REGION_DRAW = """
    SELECT * FROM (SELECT mdb_source_id, 'R' || subdivision_name AS region,
        row_number() OVER (PARTITION BY subdivision_name
            ORDER BY md5('42|' || mdb_source_id)) AS rn FROM catalog) WHERE rn <= 3"""


@query("sampled_feeds_per_region", with_views(f"SELECT mdb_source_id, region FROM ({REGION_DRAW})"))
def _(b):
    found = b.catalog.withColumn("region", F.concat(F.lit("R"), "subdivision_name"))
    return R.sample_n(found, 3, ["region"], ["mdb_source_id"], 42).select("mdb_source_id", "region")


# terms, countries and texts asked for, found and not found
ASKED = (
    ("customer#000000", "NATION_3", "large", "first"),
    ("Customer#0*17", "NATION_5", "medium", "second"),
    ("no such provider", "NATION_5", "small", "third"),
    ("5$", "NATION_11", "small", "fourth"),
)
_ASKED_SQL = ", ".join(f"({i}, '{t}', '{c}', '{k}', '{r}')" for i, (t, c, k, r) in enumerate(ASKED))
_ASKED_TABLE = f"SELECT * FROM (VALUES {_ASKED_SQL}) t(target, term, country, category, reason)"
_FOUND_TABLE = """
    SELECT *, row_number() OVER (PARTITION BY target ORDER BY mdb_source_id) AS rn
    FROM catalog JOIN asked ON country_code = country AND regexp_matches(provider, term, 'i')"""


@query(
    "select_seed_feeds",
    with_views(
        """SELECT target, CAST(mdb_source_id AS VARCHAR) AS feed_id, provider, country_code,
                  subdivision_name AS subdivision, 'nan' AS municipality,
                  coalesce(direct_download, 'nan') AS download_url, 'nan' AS license_url,
                  coalesce(status, 'nan') AS status, category, reason AS selected_reason
           FROM found WHERE rn = 1""",
        asked=_ASKED_TABLE,
        found=_FOUND_TABLE,
    ),
)
def _(b):
    return C.select_seed_feeds(b.catalog, C.target_table(b.spark, ASKED))


@query(
    "seed_feeds_round_trip",
    with_views(
        """SELECT CAST(mdb_source_id AS VARCHAR) AS feed_id, provider, country_code,
                  subdivision_name AS subdivision, 'nan' AS municipality,
                  coalesce(direct_download, 'nan') AS download_url, 'nan' AS license_url,
                  coalesce(status, 'nan') AS status, category, reason AS selected_reason
           FROM found WHERE rn = 1""",
        asked=_ASKED_TABLE,
        found=_FOUND_TABLE,
    ),
)
def _(b):
    folder = f"{shared_folder(b.spark)}/seeds-{uuid.uuid4().hex}"
    J.write_seed_feeds(C.select_seed_feeds(b.catalog, C.target_table(b.spark, ASKED)), folder)
    return J.read_seed_feeds(b.spark, folder)


@query(
    "feed_documents_round_trip",
    with_views("SELECT feed_id, provider, country_code FROM feeds"),
)
def _(b):
    folder = f"{shared_folder(b.spark)}/documents-{uuid.uuid4().hex}"
    # one folder per feed names it; its document does not
    b.feeds.withColumnRenamed("feed_id", "feed").write.partitionBy("feed").json(folder)
    found = J.read_feed_documents(b.spark, folder, name="*.json", prefix="feed=")
    return found.select("feed_id", "provider", "country_code")


@query(
    "unmatched_targets",
    with_views(
        """SELECT target, term AS search_term FROM asked
           WHERE target NOT IN (SELECT target FROM found)""",
        asked=_ASKED_TABLE,
        found=_FOUND_TABLE,
    ),
)
def _(b):
    return C.unmatched_targets(b.catalog, C.target_table(b.spark, ASKED)).select(
        "target", "search_term"
    )


@query(
    "catalog_stats",
    with_views("""
        SELECT (SELECT count(*) FROM catalog) AS total_feeds,
               (SELECT count(DISTINCT country_code) FROM catalog) AS countries,
               (SELECT count(DISTINCT provider) FROM catalog) AS unique_providers,
               string_agg(country_code || '=' || n, '|' ORDER BY n DESC, country_code)
                   AS top_countries
        FROM (SELECT country_code, count(*) AS n FROM catalog WHERE country_code IS NOT NULL
              GROUP BY 1 ORDER BY n DESC, country_code LIMIT 20)"""),
)
def _(b):
    shown = F.transform(
        "top_countries", lambda x: F.concat_ws("=", x["country_code"], x["feeds"].cast("string"))
    )
    return C.catalog_stats(b.catalog).withColumn("top_countries", F.array_join(shown, "|"))


@query(
    "value_counts",
    with_views("""
        SELECT status, count(*) AS feeds FROM catalog WHERE status IS NOT NULL GROUP BY 1"""),
)
def _(b):
    return C.value_counts(b.catalog, "status")


# --- cleaning ------------------------------------------------------------------------

_CANONICAL = """
    SELECT feed_id, route_id, route_short_name, CAST(NULL AS VARCHAR) AS route_long_name,
           route_type, CAST(NULL AS VARCHAR) AS agency_id, route_sort_order
    FROM raw_routes"""


@query("canonical_columns", with_views(_CANONICAL))
def _(b):
    return K.canonical_columns(b.raw_routes, TABLES["routes"]).drop(
        "route_desc", "route_url", "route_color", "route_text_color"
    )


_COERCED = """
    SELECT feed_id, route_id,
           CASE WHEN TRY_CAST(route_type AS DOUBLE) BETWEEN -32768 AND 32767
                THEN TRY_CAST(route_type AS DOUBLE)::INT END AS route_type,
           CASE WHEN TRY_CAST(trim(route_sort_order) AS DOUBLE) BETWEEN -2147483648 AND 2147483647
                 AND TRY_CAST(trim(route_sort_order) AS DOUBLE)
                     = floor(TRY_CAST(trim(route_sort_order) AS DOUBLE))
                THEN TRY_CAST(trim(route_sort_order) AS DOUBLE)::INT END AS route_sort_order
    FROM raw_routes"""


@query("coerce_types", with_views(_COERCED))
def _(b):
    spec = TABLES["routes"]
    typed = K.coerce_types(K.canonical_columns(b.raw_routes, spec), spec)
    return typed.select(
        "feed_id", "route_id", F.col("route_type").cast("int").alias("route_type"),
        "route_sort_order",
    )


_FIRST_COPY = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed_id, trip_id, stop_sequence
        ORDER BY stop_id, departure_time NULLS FIRST) AS rn FROM stop_times) WHERE rn = 1"""


@query(
    "dedupe_keep_first",
    with_views(
        f"SELECT feed_id, trip_id, stop_sequence, stop_id, departure_time FROM ({_FIRST_COPY})"
    ),
)
def _(b):
    return K.dedupe_keep_first(b.stop_times, TABLES["stop_times"], TIE).select(
        "feed_id", "trip_id", "stop_sequence", "stop_id", "departure_time"
    )


def _stop_time_stats(b):
    spec = TABLES["stop_times"]
    raw = b.stop_times.withColumn("_lost", F.lit(0))
    clean = K.dedupe_keep_first(b.stop_times, spec, TIE)
    headers = b.feeds.select(
        "feed_id",
        F.array(*[F.lit(c) for c in (*b.stop_times.columns[1:], "speed", "bus")]).alias("header"),
    )
    return K.cleaning_stats(raw, clean, spec, headers)


@query(
    "cleaning_stats",
    with_views(f"""
        SELECT feed_id, 'stop_times' AS "table", rows_raw, rows_cleaned,
               rows_raw - rows_cleaned AS duplicates_removed, 0 AS n_coerced_null,
               'trip_id|arrival_time|departure_time|stop_id|stop_sequence' AS columns_kept,
               'bus|speed' AS columns_dropped
        FROM (SELECT feed_id, count(*) AS rows_raw FROM stop_times GROUP BY 1)
        JOIN (SELECT feed_id, count(*) AS rows_cleaned FROM ({_FIRST_COPY}) GROUP BY 1)
             USING (feed_id)"""),
)
def _(b):
    return _stop_time_stats(b).withColumns(
        {c: F.array_join(c, "|") for c in ("columns_kept", "columns_dropped")}
    )


@query(
    "cleaning_report",
    with_views(f"""
        SELECT (SELECT count(*) FROM feeds) AS total_feeds,
               (SELECT count(*) FROM feeds WHERE feed_id <> '4') AS successful,
               (SELECT count(*) FROM feeds WHERE feed_id = '4') AS failed,
               (SELECT count(*) FROM routes) AS total_routes,
               (SELECT count(*) FROM stops) AS total_stops,
               (SELECT count(*) FROM trips) AS total_trips,
               (SELECT count(*) FROM ({_FIRST_COPY})) AS total_stop_times"""),
)
def _(b):
    columns = ["feed_id", "table", "rows_cleaned"]
    stats = _stop_time_stats(b).select(*columns)
    for name in ("routes", "stops", "trips"):
        clean = K.dedupe_keep_first(getattr(b, name), TABLES[name])
        counts = K.row_counts(clean, "rows_cleaned").withColumn("table", F.lit(name))
        stats = stats.unionByName(counts.select(*columns))
    return K.cleaning_report(stats, b.feeds.withColumn("success", F.col("feed_id") != "4"))


@query(
    "report_round_trip",
    with_views("""
        SELECT (SELECT count(*) FROM catalog) AS total_feeds,
               (SELECT count(DISTINCT country_code) FROM catalog) AS countries,
               (SELECT count(DISTINCT provider) FROM catalog) AS unique_providers,
               true AS stamped"""),
)
def _(b):
    folder = f"{shared_folder(b.spark)}/report-{uuid.uuid4().hex}"
    J.write_report(C.catalog_stats(b.catalog), folder)
    return b.spark.read.json(folder).select(
        "total_feeds", "countries", "unique_providers",
        F.col("generated_at").isNotNull().alias("stamped"),
    )


@query(
    "trim_headers",
    with_views("SELECT feed_id, route_id, route_short_name, route_type FROM routes"),
)
def _(b):
    padded = b.routes.select("feed_id", "route_id", "route_short_name", "route_type").toDF(
        "feed_id", " route_id", "route_short_name ", "\troute_type "
    )
    return K.trim_headers(padded)


@query(
    "clean_store_round_trip",
    with_views("SELECT feed_id, route_id, route_short_name, route_type FROM routes"),
)
def _(b):
    folder = f"{shared_folder(b.spark)}/clean-{uuid.uuid4().hex}"
    lake.write_clean(b.routes, folder, "routes")
    return lake.read_clean(
        b.spark, folder, "routes", ["route_id", "route_short_name", "route_type"]
    )


# --- references ------------------------------------------------------------------------


@query(
    "orphans",
    with_views("""
        SELECT DISTINCT feed_id, stop_id FROM stop_times s
        WHERE NOT EXISTS (SELECT 1 FROM stops p WHERE p.feed_id = s.feed_id
                          AND p.stop_id = s.stop_id AND p.stop_lat > 20)"""),
)
def _(b):
    return I.orphans(b.stop_times, b.stops.where("stop_lat > 20"), "stop_id")


@query(
    "known_services",
    with_views("""
        SELECT feed_id, service_id FROM calendar
        UNION SELECT feed_id, service_id FROM calendar_dates"""),
)
def _(b):
    return I.known_services(b.calendar, b.calendar_dates)


_PARENTS = {
    "some_trips": "SELECT * FROM trips WHERE _pos % 5 <> 0",
    "some_routes": "SELECT * FROM routes WHERE route_type IS NOT NULL",
}


@query(
    "integrity_report",
    with_views(
        """
        SELECT feed_id,
          (SELECT count(*) FROM (SELECT feed_id, trip_id FROM stop_times
             EXCEPT SELECT feed_id, trip_id FROM some_trips) o WHERE o.feed_id = f.feed_id)
             AS orphan_trip_ids_in_stop_times,
          (SELECT count(*) FROM (SELECT feed_id, route_id FROM some_trips
             EXCEPT SELECT feed_id, route_id FROM some_routes) o WHERE o.feed_id = f.feed_id)
             AS orphan_route_ids_in_trips,
          CASE WHEN feed_id IN (SELECT feed_id FROM stops) THEN
          (SELECT count(*) FROM (SELECT feed_id, stop_id FROM stop_times
             EXCEPT SELECT feed_id, stop_id FROM stops) o WHERE o.feed_id = f.feed_id) END
             AS orphan_stop_ids_in_stop_times,
          (SELECT count(*) FROM (SELECT feed_id, service_id FROM some_trips
             EXCEPT (SELECT feed_id, service_id FROM calendar
                     UNION SELECT feed_id, service_id FROM calendar_dates)) o
             WHERE o.feed_id = f.feed_id) AS orphan_service_ids_in_trips
        FROM feeds f""",
        **_PARENTS,
    ),
)
def _(b):
    tables = b.tables.as_dict() | {
        "trips": b.trips.where("_pos % 5 <> 0"),
        "routes": b.routes.where("route_type is not null"),
    }
    return I.integrity_report(tables)


@query(
    "required_tables",
    """
    WITH present AS (
        SELECT n_nationkey AS k, 'agency.txt' AS basename FROM nation
        UNION SELECT c_nationkey, 'routes.txt' FROM customer
        UNION SELECT c_nationkey, 'trips.txt' FROM customer JOIN orders ON o_custkey = c_custkey
        UNION SELECT s_nationkey, 'stops.txt' FROM supplier WHERE s_acctbal > 5000)
    SELECT CAST(n_nationkey AS VARCHAR) AS feed_id, basename,
           'Missing required file: ' || basename AS error
    FROM nation, (VALUES ('agency.txt'), ('routes.txt'), ('trips.txt'), ('stops.txt'),
                         ('stop_times.txt')) t(basename)
    WHERE (n_nationkey, basename) NOT IN (SELECT k, basename FROM present)""",
)
def _(b):
    customers = b.raw("customer")
    held = {
        "agency.txt": b.raw("nation").select(F.col("n_nationkey").alias("k")),
        "routes.txt": customers.select(F.col("c_nationkey").alias("k")),
        "trips.txt": customers.join(
            b.raw("orders"), F.col("o_custkey") == F.col("c_custkey")
        ).select(F.col("c_nationkey").alias("k")),
        "stops.txt": b.raw("supplier").where("s_acctbal > 5000").select(
            F.col("s_nationkey").alias("k")
        ),
    }
    present = None
    for name, keys in held.items():
        part = keys.distinct().select(
            F.col("k").cast("string").alias("feed_id"), F.lit(name).alias("basename")
        )
        present = part if present is None else present.unionByName(part)
    feeds = b.raw("nation").selectExpr("string(n_nationkey) as feed_id")
    return I.required_tables(present, feeds)


# --- statistics ------------------------------------------------------------------------

_SCHEDULE = """
    SELECT feed_id, route_id, trip_count, stop_count, first_departure, last_departure,
           array_to_string(headsigns, '|') AS headsigns FROM route_stats"""
_KEPT = ["feed_id", "route_id", "trip_count", "stop_count", "first_departure", "last_departure"]


@query("route_schedules", with_stats(f"{_SCHEDULE} WHERE trip_count > 0"))
def route_schedules(b):
    return S.route_schedules(b.trips, b.stop_times, tie=TIE).select(*_KEPT, text("headsigns"))


@query(
    "route_schedules_by_seconds",
    with_stats(
        """SELECT feed_id, route_id, epoch(CAST(first_departure AS INTERVAL))::BIGINT AS first,
                  epoch(CAST(last_departure AS INTERVAL))::BIGINT AS last
           FROM route_stats WHERE trip_count > 0""",
        order="seconds",
    ),
)
def _(b):
    from headway.functions.scalars import gtfs_seconds

    by_time = S.route_schedules(b.trips, b.stop_times, order="seconds", tie=TIE)
    return by_time.select(
        "feed_id",
        "route_id",
        gtfs_seconds(F.col("first_departure")).cast("bigint").alias("first"),
        gtfs_seconds(F.col("last_departure")).cast("bigint").alias("last"),
    )


@query("routes_with_schedule", with_stats(_SCHEDULE))
def _(b):
    return b.summary.route_stats.select(*_KEPT, text("headsigns"))


@query(
    "first_stop_per_trip",
    with_views(f"""
        SELECT feed_id, trip_id, stop_sequence, stop_id, departure_time FROM (
            SELECT *, row_number() OVER (PARTITION BY feed_id, trip_id ORDER BY {O._TIE}) AS rn
            FROM stop_times) WHERE rn = 1"""),
)
def _(b):
    return S.first_stop_per_trip(b.stop_times, TIE).select(
        "feed_id", "trip_id", "stop_sequence", "stop_id", "departure_time"
    )


@query(
    "stop_times_with_route",
    with_views("""
        SELECT s.feed_id, route_id, trip_id, stop_sequence, stop_id
        FROM stop_times s JOIN trips t USING (feed_id, trip_id)"""),
)
def _(b):
    return S.stop_times_with_route(b.stop_times, b.trips).select(
        "feed_id", "route_id", "trip_id", "stop_sequence", "stop_id"
    )


@query(
    "scheduled_routes",
    with_stats("""
        SELECT feed_id, route_id FROM route_stats
        WHERE first_departure <> '' AND last_departure <> '' AND route_short_name <> ''"""),
)
def _(b):
    return S.scheduled_routes(b.summary.route_stats).select("feed_id", "route_id")


@query(
    "running_routes",
    with_stats("""
        SELECT feed_id, route_id, trip_count FROM route_stats
        WHERE first_departure <> '' AND trip_count > 0"""),
)
def _(b):
    return S.scheduled_routes(b.summary.route_stats, need_names=False).select(
        "feed_id", "route_id", "trip_count"
    )


@query(
    "early_routes",
    with_stats(
        "SELECT feed_id, route_id, first_departure FROM route_stats"
        " WHERE first_departure < '06:00'"
    ),
)
def _(b):
    return S.early_routes(b.summary.route_stats).select("feed_id", "route_id", "first_departure")


@query(
    "late_routes",
    with_stats(
        "SELECT feed_id, route_id, last_departure FROM route_stats WHERE last_departure > '23:00'"
    ),
)
def _(b):
    return S.late_routes(b.summary.route_stats).select("feed_id", "route_id", "last_departure")


@query(
    "late_routes_by_seconds",
    with_stats(f"""
        SELECT feed_id, route_id, last_departure FROM route_stats
        WHERE {O.minutes('last_departure')} > 23 * 60"""),
)
def _(b):
    return S.late_routes(b.summary.route_stats, order="seconds").select(
        "feed_id", "route_id", "last_departure"
    )


@query(
    "routes_of_type",
    with_views("SELECT feed_id, route_id FROM routes WHERE route_type = 3"),
)
def _(b):
    return S.routes_of_type(b.routes, 3).select("feed_id", "route_id")


@query(
    "stations",
    with_views("SELECT feed_id, stop_id, stop_name FROM stops WHERE location_type = 1"),
)
def _(b):
    return M.stations(b.stops).select("feed_id", "stop_id", "stop_name")


@query(
    "listed_stations",
    with_views(
        f"SELECT feed_id, stop_id FROM ({O.first_n('st', 50, 'feed_id', '_pos')})",
        st="SELECT * FROM stops WHERE location_type = 1",
    ),
)
def _(b):
    return M.listed_stations(b.stops, n=50).select("feed_id", "stop_id")


@query(
    "agency_summary",
    with_views("""
        SELECT feed_id, agency_id, agency_name, agency_url,
               coalesce(agency_timezone, '') AS agency_timezone FROM agency"""),
)
def _(b):
    return M.agency_summary(b.agency).drop("_pos")


@query(
    "route_summary",
    with_views("""
        SELECT feed_id, route_id, coalesce(route_short_name, '') AS route_short_name,
               coalesce(route_long_name, '') AS route_long_name, route_type, agency_id
        FROM routes"""),
)
def _(b):
    return M.route_summary(b.routes)


@query(
    "stop_summary",
    with_views("""
        SELECT feed_id, stop_id, stop_name, stop_lat, stop_lon, zone_id, '' AS parent_station
        FROM stops"""),
)
def _(b):
    return M.stop_summary(b.stops)


@query(
    "routes_by_type",
    with_views("""
        SELECT feed_id, route_type, count(*) AS n FROM routes WHERE route_type IS NOT NULL
        GROUP BY 1, 2"""),
)
def _(b):
    return M.routes_by_type(b.routes)


@query(
    "stops_by_location_type",
    with_views("""
        SELECT feed_id, location_type, count(*) AS n FROM stops
        WHERE location_type IS NOT NULL GROUP BY 1, 2"""),
)
def _(b):
    return M.stops_by_location_type(b.stops)


@query("calendar_summary", with_stats("SELECT * FROM calendars"))
def _(b):
    return b.summary.calendar


@query(
    "network_stats",
    with_stats("""
        SELECT feed_id, total_routes, total_stops, total_trips, avg_stops_per_route,
               avg_trips_per_route FROM feed_stats"""),
)
def _(b):
    return b.summary.network


@query(
    "network_stats_listed",
    with_stats("""
        SELECT f.feed_id, total_routes, total_stops, l.n AS total_trips, avg_stops_per_route,
               round(l.n / total_routes, 1) AS avg_trips_per_route
        FROM feed_stats f
        JOIN (SELECT feed_id, CAST(sum(trip_count) AS BIGINT) AS n FROM listed WHERE rn <= 50 GROUP BY 1) l
             USING (feed_id)"""),
)
def _(b):
    return M.network_stats(b.routes, b.stops, b.summary.route_stats, scope="listed")


for _missing, _other in (("blank", "''"), ("id", None)):

    @query(
        f"transfers_with_names_{_missing}",
        with_views(f"""
            SELECT x.feed_id, from_stop_id, to_stop_id, transfer_type, min_transfer_time,
                   coalesce(a.stop_name, {_other or 'from_stop_id'}) AS from_stop_name,
                   coalesce(b.stop_name, {_other or 'to_stop_id'}) AS to_stop_name
            FROM transfers x
            LEFT JOIN stops a ON a.feed_id = x.feed_id AND a.stop_id = from_stop_id
            LEFT JOIN stops b ON b.feed_id = x.feed_id AND b.stop_id = to_stop_id"""),
    )
    def _(b, missing=_missing):
        return M.transfers_with_names(b.transfers, b.stops, missing)


@query(
    "only_feeds",
    with_views("""
        SELECT feed_id, trip_id FROM trips
        WHERE feed_id IN (SELECT feed_id FROM feeds WHERE provider LIKE 'A%')"""),
)
def _(b):
    return M.only_feeds(b.trips, b.feeds.where("provider like 'A%'")).select("feed_id", "trip_id")


@query(
    "providers_by_country",
    with_views("""
        SELECT country_code, string_agg(provider, ', ' ORDER BY feed_id) AS providers
        FROM feeds WHERE country_code <> '' GROUP BY 1"""),
)
def _(b):
    return M.providers_by_country(b.feeds)


_MODES = "SELECT feed_id, count(DISTINCT route_type) AS modes FROM routes GROUP BY 1"


@query("modes_per_feed", with_views(_MODES))
def _(b):
    return M.modes_per_feed(b.routes)


@query("multimodal_feeds", with_views(f"SELECT * FROM ({_MODES}) WHERE modes > 1"))
def _(b):
    return M.multimodal(b.routes)


@query(
    "most_diverse_feed",
    with_views(f"SELECT * FROM ({_MODES}) ORDER BY modes DESC, feed_id LIMIT 1"),
)
def _(b):
    return M.most_diverse_feed(b.routes)


@query(
    "services_without_calendar",
    with_views("""
        SELECT feed_id, service_id FROM trips
        EXCEPT SELECT feed_id, service_id FROM calendar"""),
)
def _(b):
    key = ["feed_id", "service_id"]
    return M.missing_keys(b.trips.select(*key), b.calendar.select(*key))


@query(
    "services_in_both_calendars",
    with_views("""
        SELECT feed_id, service_id FROM calendar
        INTERSECT SELECT feed_id, service_id FROM calendar_dates"""),
)
def _(b):
    key = ["feed_id", "service_id"]
    return M.shared_keys(b.calendar.select(*key), b.calendar_dates.select(*key))


_SIGNS = ("F 1-URGENT", "F 5-LOW", "O 2-HIGH", "P 5-LOW")


@query(
    "headsign_sets",
    with_stats(f"""
        SELECT feed_id, route_id,
               array_to_string(list_sort(list_filter({list(_SIGNS)},
                   lambda x: NOT list_contains(headsigns, x))), '|') AS missing,
               array_to_string(list_sort(list_filter(headsigns,
                   lambda x: list_contains({list(_SIGNS)}, x))), '|') AS shared
        FROM route_stats"""),
)
def _(b):
    signs = b.summary.route_stats.withColumn("wanted", F.array(*[F.lit(x) for x in _SIGNS]))
    signs = M.missing_entries(signs, "wanted", "headsigns", "missing")
    signs = M.shared_entries(signs, "headsigns", "wanted", "shared")
    return signs.select("feed_id", "route_id", text("missing"), text("shared"))


# --- ranking ---------------------------------------------------------------------------


@query(
    "first_n_per_feed",
    with_views(f"SELECT feed_id, route_id FROM ({O.first_n('routes', 50, 'feed_id', '_pos')})"),
)
def _(b):
    return R.first_n_per_feed(b.routes, 50).select("feed_id", "route_id")


@query("sample_n_per_feed", with_stats("SELECT feed_id, stop_id FROM stop_draw WHERE draw <= 7"))
def _(b):
    return R.sample_n_per_feed(b.stops, 7, ["stop_id"], 42).select("feed_id", "stop_id")


_PICKED = {
    "tops": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed_id
            ORDER BY trip_count DESC, _pos) AS pick
        FROM (SELECT * EXCLUDE (rn) FROM listed) WHERE trip_count > 0) WHERE pick <= 7""",
    "others": f"""
        SELECT * REPLACE (pick + 7 AS pick) FROM (
            SELECT *, row_number() OVER (PARTITION BY feed_id
                ORDER BY {O.seeded("route_id")}, route_id) AS pick
            FROM (SELECT * EXCLUDE (rn) FROM listed) l WHERE trip_count > 0
              AND (feed_id, route_id) NOT IN (SELECT feed_id, route_id FROM tops))
        WHERE pick <= 8""",
    "picked": "SELECT * FROM tops UNION ALL SELECT * FROM others",
}


@query(
    "pick_routes", with_stats("SELECT feed_id, route_id, pick FROM picked", **_PICKED)
)
def _(b):
    return R.pick_routes(b.listed.listed_routes).select("feed_id", "route_id", "pick")


for _metric in ("total_routes", "total_stops", "total_trips"):

    @query(
        f"top_feeds_by_{_metric}",
        with_stats(f"""
            SELECT feed_id, {_metric}, row_number() OVER (ORDER BY {_metric} DESC, feed_id)
                AS rank FROM feed_stats"""),
    )
    def _(b, metric=_metric):
        return R.top_feeds(b.summary.feed_stats, metric).select("feed_id", metric, "rank")


@query(
    "last_feed",
    with_stats("""
        SELECT feed_id, total_trips FROM feed_stats ORDER BY total_trips, feed_id DESC LIMIT 1"""),
)
def _(b):
    return R.last_feed(b.summary.feed_stats, "total_trips").select("feed_id", "total_trips")


for _name, _metric in (("busiest_route", "trip_count"), ("most_stops_route", "stop_count")):

    @query(
        _name,
        with_stats(f"""
            SELECT feed_id, route_id, {_metric} FROM (
                {O.first_n('route_stats', 1, 'feed_id', f'{_metric} DESC, _pos')})"""),
    )
    def _(b, metric=_metric):
        return R.best_route(b.listed.route_stats, metric).select("feed_id", "route_id", metric)


_ONE = f"""
    SELECT * FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY feed_id
        ORDER BY {O.seeded("route_id")}) AS draw
    FROM ({O.first_n('routes', 20, 'feed_id', '_pos')})) WHERE draw = 1"""


@query("pick_one", with_views(f"SELECT feed_id, route_id FROM ({_ONE})"))
def _(b):
    return R.pick_one(b.routes, 20, ["route_id"], 42).select("feed_id", "route_id")


@query(
    "slot_ranks",
    with_views(f"""
        SELECT feed_id, trip_id, row_number() OVER (PARTITION BY feed_id
            ORDER BY {O.seeded("trip_id", 7)}) AS rank FROM trips"""),
)
def _(b):
    return R.slot_ranks(b.trips, ["trip_id"], 7, ["feed_id"]).select("feed_id", "trip_id", "rank")


_PAIRED = f"""
    SELECT (rank - 1) // 2 AS pair, rank % 2 AS side, feed_id, provider
    FROM (SELECT *, row_number() OVER (ORDER BY {O.seeded("feed_id")}) AS rank FROM feeds)"""


@query(
    "shuffled_pairs",
    with_views(
        """SELECT pair, a.feed_id AS a_feed_id, a.provider AS a_provider,
                  b.feed_id AS b_feed_id, b.provider AS b_provider
           FROM (SELECT * FROM paired WHERE side = 1) a
           JOIN (SELECT * FROM paired WHERE side = 0) b USING (pair)""",
        paired=_PAIRED,
    ),
)
def _(b):
    return R.shuffled_pairs(b.feeds, columns=["feed_id", "provider"])


@query(
    "neighbour_pairs",
    with_views("""
        SELECT pair, a_feed_id, b_feed_id FROM (
            SELECT row_number() OVER (ORDER BY feed_id) AS pair, feed_id AS a_feed_id,
                   lead(feed_id) OVER (ORDER BY feed_id) AS b_feed_id FROM feeds)
        WHERE b_feed_id IS NOT NULL AND pair <= 10"""),
)
def _(b):
    return R.neighbour_pairs(b.feeds).select("pair", "a_feed_id", "b_feed_id")


@query(
    "assign_ids",
    with_views("""
        SELECT feed_id, trip_id,
               printf('BM-%04d', row_number() OVER (ORDER BY service_id, _pos)) AS id
        FROM trips"""),
)
def _(b):
    return R.assign_ids(b.trips, ["service_id", "_pos"]).select("feed_id", "trip_id", "id")


@query(
    "limit_rows",
    with_views("SELECT trip_id, route_id FROM trips ORDER BY service_id, _pos LIMIT 100"),
)
def _(b):
    return R.limit_rows(b.trips, 100, ["service_id", "_pos"]).select("trip_id", "route_id")
