"""The views of ``headway.bindings.views`` as SQL, and the queries' expected results."""

from __future__ import annotations

# The expected names, written out so that they do not follow the code they check.
ROUTE_TYPES = {
    0: "Tram/Streetcar/Light rail",
    1: "Subway/Metro",
    2: "Rail/Commuter rail",
    3: "Bus",
    4: "Ferry",
    5: "Cable tram",
    6: "Aerial lift/Gondola",
    7: "Funicular",
    11: "Trolleybus",
    12: "Monorail",
}
ROUTE_TYPES_SHORT = {
    0: "Tram/Light Rail",
    1: "Subway/Metro",
    2: "Rail",
    3: "Bus",
    4: "Ferry",
    5: "Cable Tram",
    6: "Gondola",
    7: "Funicular",
    11: "Trolleybus",
    12: "Monorail",
}
TRANSFER_TYPES = {
    0: "Recommended transfer point",
    1: "Timed transfer (vehicle waits)",
    2: "Minimum time required",
    3: "No transfer possible",
}
DEMAND_VERBS = (
    "mention|state|explain|identify|list|note|confirm|distinguish|define|contrast|calculate"
)

SEGMENTS = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN 3 WHEN 'AUTOMOBILE' THEN 1 WHEN 'MACHINERY' THEN 0"
    " WHEN 'HOUSEHOLD' THEN 99 END"
)
_HOUR = "(CAST(l_quantity AS INT) % 28)"
_TIME = (
    f"CASE WHEN l_linestatus = 'O' THEN lpad(CAST({_HOUR} AS VARCHAR), 2, '0')"
    f" ELSE CAST({_HOUR} AS VARCHAR) END || ':' ||"
    " lpad(CAST(CAST(floor(l_extendedprice) AS INT) % 60 AS VARCHAR), 2, '0') || ':00'"
)
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

# table expressions by name, in an order where each uses earlier ones only
VIEWS = {
    "feeds": """
        SELECT CAST(r_regionkey AS VARCHAR) AS feed_id, r_name AS provider,
               substr(r_name, 1, 2) AS country_code
        FROM region""",
    "agency": """
        SELECT CAST(n_regionkey AS VARCHAR) AS feed_id, CAST(n_nationkey AS VARCHAR) AS agency_id,
               n_name AS agency_name, 'http://' || lower(n_name) || '.example' AS agency_url,
               CASE WHEN n_nationkey % 5 <> 0 THEN 'Etc/' || n_name END AS agency_timezone,
               n_nationkey AS _pos
        FROM nation""",
    "routes": f"""
        SELECT CAST(n_regionkey AS VARCHAR) AS feed_id, CAST(c_custkey AS VARCHAR) AS route_id,
               CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS route_short_name,
               CASE WHEN c_acctbal >= 2000 THEN c_mktsegment || ' line' END AS route_long_name,
               {SEGMENTS} AS route_type, CAST(c_nationkey AS VARCHAR) AS agency_id,
               c_custkey AS _pos
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "trips": """
        SELECT feed_id, CAST(o_orderkey AS VARCHAR) AS trip_id, route_id,
               o_orderpriority || '/' || strftime(o_orderdate, '%Y%m') AS service_id,
               CASE WHEN o_totalprice >= 5000 THEN o_orderstatus || ' ' || o_orderpriority END
                   AS trip_headsign,
               o_orderkey AS _pos
        FROM orders JOIN routes ON o_custkey = routes._pos""",
    "stops": """
        SELECT CAST(n_regionkey AS VARCHAR) AS feed_id, CAST(s_suppkey AS VARCHAR) AS stop_id,
               s_name AS stop_name, s_acctbal / 100 AS stop_lat, s_acctbal / -50 AS stop_lon,
               CAST(s_nationkey AS VARCHAR) AS zone_id,
               CASE WHEN s_suppkey % 11 <> 0 THEN s_suppkey % 3 END AS location_type,
               CAST(NULL AS VARCHAR) AS parent_station, s_suppkey AS _pos
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "stop_times": f"""
        SELECT feed_id, trip_id, l_linenumber AS stop_sequence,
               CAST(l_suppkey AS VARCHAR) AS stop_id, {_TIME} AS arrival_time,
               CASE WHEN l_discount = 0 AND l_returnflag = 'R' THEN NULL
                    WHEN l_discount = 0 THEN '' ELSE {_TIME} END AS departure_time
        FROM lineitem JOIN trips ON l_orderkey = trips._pos""",
    "dated": """
        SELECT feed_id, o_orderkey, o_orderstatus,
               o_orderpriority || '/' || strftime(o_orderdate, '%Y%m') AS service_id,
               strftime(o_orderdate, '%Y%m%d') AS date, isodow(o_orderdate) - 1 AS day
        FROM orders JOIN routes ON o_custkey = routes._pos""",
    "calendar": f"""
        SELECT feed_id, service_id,
               {", ".join(f"max(CAST(day = {i} AS INT)) AS {d}" for i, d in enumerate(DAYS))},
               min(date) AS start_date, max(date) AS end_date
        FROM dated WHERE feed_id <> '4' GROUP BY feed_id, service_id""",
    "calendar_dates": """
        SELECT feed_id, service_id, date, 1 + min(o_orderkey) % 2 AS exception_type
        FROM dated WHERE o_orderstatus = 'F' GROUP BY feed_id, service_id, date""",
    "moves": """
        SELECT l_orderkey, l_suppkey AS from_key,
               lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey)
                   AS to_key
        FROM lineitem""",
    "transfers": """
        SELECT DISTINCT feed_id, CAST(from_key AS VARCHAR) AS from_stop_id,
               CAST(to_key AS VARCHAR) AS to_stop_id,
               CASE WHEN (from_key + to_key) % 6 < 5 THEN (from_key + to_key) % 6 END
                   AS transfer_type,
               CASE WHEN (from_key + to_key) % 6 = 2 THEN from_key % 7 * 90 END
                   AS min_transfer_time
        FROM moves JOIN trips ON l_orderkey = trips._pos WHERE to_key IS NOT NULL""",
    "raw_routes": f"""
        SELECT c_mktsegment AS segment,
               CASE c_custkey % 8 WHEN 0 THEN '1.0' WHEN 1 THEN '1.5' WHEN 2 THEN 'x'
                    WHEN 3 THEN '-2' WHEN 4 THEN '99999999999' WHEN 5 THEN ''
                    WHEN 6 THEN ' 12 ' ELSE CAST(c_custkey AS VARCHAR) END AS route_sort_order,
               coalesce(CAST({SEGMENTS} AS VARCHAR), '70000') AS route_type,
               c_name AS route_short_name, CAST(c_custkey AS VARCHAR) AS route_id,
               CAST(n_regionkey AS VARCHAR) AS feed_id
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "catalog": """
        SELECT c_custkey AS mdb_source_id,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'gtfs-rt' ELSE 'gtfs' END AS data_type,
               CASE c_custkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive'
                    WHEN 2 THEN 'deprecated' END AS status,
               CASE WHEN c_custkey % 31 <> 0 THEN c_name END AS provider,
               CASE WHEN c_custkey % 13 <> 0 THEN n_name END AS country_code,
               'S' || n_regionkey AS subdivision_name,
               CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN ''
                    ELSE 'http://feeds.example/' || c_custkey || '.zip' END AS direct_download,
               CASE c_custkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 END
                   AS authentication_type
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "turns": """
        SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
               lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS reply
        FROM conversations""",
    "pairs": """
        SELECT conv_id * 100 + turn AS record, text AS instruction, reply AS response,
               CASE conv_id % 6 WHEN 0 THEN 'agency_overview' WHEN 1 THEN 'route_info'
                    WHEN 2 THEN 'schedule' WHEN 3 THEN 'stop_info'
                    WHEN 4 THEN 'network_stats' END AS category,
               'turn_' || turn AS template_id, CAST(conv_id % 7 AS VARCHAR) AS feed_id,
               CAST(NULL AS VARCHAR) AS provider
        FROM turns WHERE role = 'user' AND next_role = 'assistant'
        UNION ALL
        SELECT -1 - doc_id, text,
               CASE WHEN doc_id % 50 = 0 THEN ' ' WHEN doc_id % 50 = 1 THEN lang
                    ELSE source || ' holds a text in ' || lang END,
               source, CASE WHEN doc_id % 17 <> 0 THEN lang END,
               CASE WHEN doc_id % 3 = 0 THEN '' ELSE CAST(doc_id % 5 AS VARCHAR) END, source
        FROM documents""",
    "scored": """
        SELECT CAST(event_id AS VARCHAR) AS id, event_type AS category,
               CASE user_id % 4 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' WHEN 2 THEN 'hard' END
                   AS difficulty,
               event_id % 1000 / 1000 AS rouge_l, user_id % 5 / 4 AS keyword_match,
               user_id % 3 / 2 AS criteria_match
        FROM events""",
}


def with_views(body: str, **extra: str) -> str:
    """A query over the views and further named table expressions."""
    tables = {**VIEWS, **extra}
    listed = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in tables.items())
    return f"WITH {listed}\n{body.strip()}"


def seeded(key: str, seed: int = 42) -> str:
    return f"md5('{seed}|' || {key})"


def thousands(c: str) -> str:
    return f"format('{{:,}}', CAST({c} AS BIGINT))"


def coded(c: str, names: dict[int, str], otherwise: str) -> str:
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in names.items())
    return f"CASE {c} {cases} ELSE {otherwise} END"


def mode(c: str) -> str:
    return coded(c, ROUTE_TYPES, f"'Unknown (type ' || {c} || ')'")


def clock(c: str, next_day: str = " (next day)") -> str:
    """A GTFS time as a time of day."""
    hour = f"TRY_CAST(split_part({c}, ':', 1) AS INT)"
    of_day = f"(CASE WHEN {hour} >= 24 THEN {hour} - 24 ELSE {hour} END)"
    return (
        f"CASE WHEN coalesce({c}, '') = '' THEN 'unknown'"
        f" WHEN len(string_split({c}, ':')) <> 3 OR {hour} IS NULL THEN {c}"
        f" ELSE (CASE WHEN {of_day} = 0 THEN 12 WHEN {of_day} > 12 THEN {of_day} - 12"
        f" ELSE {of_day} END) || ':' || split_part({c}, ':', 2)"
        f" || CASE WHEN {of_day} < 12 THEN ' AM' ELSE ' PM' END"
        f" || CASE WHEN {hour} >= 24 THEN '{next_day}' ELSE '' END END"
    )


def minutes(c: str) -> str:
    return (
        f"(TRY_CAST(split_part({c}, ':', 1) AS INT) * 60 +"
        f" TRY_CAST(split_part({c}, ':', 2) AS INT))"
    )


def first_n(table: str, n: int, by: str, order: str) -> str:
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS rn"
        f" FROM {table}) WHERE rn <= {n}"
    )


NAME = "coalesce(nullif(route_short_name, ''), nullif(route_long_name, ''), '')"
_TIE = "stop_sequence, stop_id NULLS FIRST, departure_time NULLS FIRST"


def stats_views(order: str = "text") -> dict[str, str]:
    """Route and feed statistics."""
    if order == "text":
        first, last = "min(departure)", "max(departure)"
    else:
        at = f"{minutes('departure')} * 60"
        first, last = f"arg_min(departure, {at})", f"arg_max(departure, {at})"
    return {
        "starts": f"""
            SELECT feed_id, trip_id, departure_time AS departure FROM (
                SELECT *, row_number() OVER (PARTITION BY feed_id, trip_id ORDER BY {_TIE}) AS rn
                FROM stop_times) WHERE rn = 1 AND trim(departure_time) <> ''""",
        "departures": f"""
            SELECT s.feed_id, route_id, {first} AS first_departure, {last} AS last_departure
            FROM starts s JOIN trips t USING (feed_id, trip_id) GROUP BY 1, 2""",
        "visits": """
            SELECT s.feed_id, route_id, count(DISTINCT stop_id) AS stop_count
            FROM stop_times s JOIN trips t USING (feed_id, trip_id) GROUP BY 1, 2""",
        "runs": """
            SELECT feed_id, route_id, count(DISTINCT trip_id) AS trip_count,
                   list_slice(list_sort(list(DISTINCT trip_headsign)
                       FILTER (trip_headsign IS NOT NULL)), 1, 5) AS headsigns
            FROM trips GROUP BY 1, 2""",
        "route_stats": """
            SELECT r.*, coalesce(trip_count, 0) AS trip_count,
                   coalesce(stop_count, 0) AS stop_count, first_departure, last_departure,
                   coalesce(headsigns, []) AS headsigns
            FROM routes r LEFT JOIN runs USING (feed_id, route_id)
            LEFT JOIN visits USING (feed_id, route_id)
            LEFT JOIN departures USING (feed_id, route_id)""",
        "listed": """
            SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY _pos) AS rn
            FROM route_stats""",
        "types": """
            SELECT feed_id, route_type, count(*) AS n FROM routes
            WHERE route_type IS NOT NULL GROUP BY 1, 2""",
        "modes": f"""
            SELECT feed_id, count(*) AS modes,
                   string_agg(n || ' ' || {mode("route_type")} || ' route'
                       || CASE WHEN n <> 1 THEN 's' ELSE '' END, ', ' ORDER BY route_type)
                       AS modes_text,
                   string_agg(n || ' are ' || {mode("route_type")} || ' routes', '. '
                       ORDER BY route_type) AS breakdown,
                   string_agg(n || ' ' || {mode("route_type")}, ', ' ORDER BY route_type)
                       AS mode_counts,
                   string_agg(n || ' ' || {coded("route_type", ROUTE_TYPES,
                       "'type ' || route_type")}, ', ' ORDER BY route_type) AS shown_counts,
                   string_agg({coded("route_type", ROUTE_TYPES, "'type ' || route_type")}, ', '
                       ORDER BY route_type) AS mode_names
            FROM types GROUP BY 1""",
        "services": f"""
            SELECT feed_id,
                   count(*) FILTER ({" OR ".join(f"{d} = 1" for d in DAYS[:5])}) AS weekday,
                   count(*) FILTER (saturday = 1 OR sunday = 1) AS weekend,
                   min(start_date) AS d0, max(end_date) AS d1
            FROM calendar GROUP BY 1""",
        "exceptions": """
            SELECT feed_id, count(*) AS n, min(date) AS d0, max(date) AS d1
            FROM calendar_dates GROUP BY 1""",
        "calendars": """
            SELECT coalesce(s.feed_id, e.feed_id) AS feed_id,
                   coalesce(weekday, 0) AS weekday_services,
                   coalesce(weekend, 0) AS weekend_services,
                   coalesce(n, 0) AS calendar_dates_count,
                   CASE WHEN s.d0 IS NOT NULL AND s.d1 IS NOT NULL THEN s.d0 ELSE e.d0 END
                       AS range_start,
                   CASE WHEN s.d0 IS NOT NULL AND s.d1 IS NOT NULL THEN s.d1 ELSE e.d1 END
                       AS range_end
            FROM services s FULL JOIN exceptions e ON s.feed_id = e.feed_id""",
        "feed_stats": """
            SELECT f.*, coalesce(r.n, 0) AS total_routes, coalesce(s.n, 0) AS total_stops,
                   coalesce(t.n, 0) AS total_trips,
                   coalesce(round(coalesce(s.n, 0) / r.n, 1), 0) AS avg_stops_per_route,
                   coalesce(round(coalesce(t.n, 0) / r.n, 1), 0) AS avg_trips_per_route,
                   coalesce(s.stations, 0) AS station_count,
                   coalesce(x.n, 0) AS total_transfers,
                   coalesce(weekday_services, 0) AS weekday_services,
                   coalesce(weekend_services, 0) AS weekend_services, range_start, range_end,
                   coalesce(m.modes, 0) AS modes, modes_text, breakdown, mode_counts,
                   shown_counts, mode_names
            FROM feeds f
            LEFT JOIN (SELECT feed_id, count(*) AS n FROM routes GROUP BY 1) r USING (feed_id)
            LEFT JOIN (SELECT feed_id, count(*) AS n,
                              count(*) FILTER (location_type = 1) AS stations
                       FROM stops GROUP BY 1) s USING (feed_id)
            LEFT JOIN (SELECT feed_id, CAST(sum(trip_count) AS BIGINT) AS n FROM route_stats GROUP BY 1) t
                USING (feed_id)
            LEFT JOIN (SELECT feed_id, count(*) AS n FROM transfers GROUP BY 1) x USING (feed_id)
            LEFT JOIN calendars USING (feed_id)
            LEFT JOIN modes m USING (feed_id)""",
        "stop_draw": f"""
            SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY {seeded("stop_id")}, stop_id)
                AS draw FROM stops""",
        "transfer_draw": f"""
            SELECT x.*, coalesce(a.stop_name, '') AS from_stop_name,
                   coalesce(b.stop_name, '') AS to_stop_name,
                   row_number() OVER (PARTITION BY x.feed_id
                       ORDER BY {seeded("from_stop_id || '|' || to_stop_id")}) AS draw
            FROM transfers x
            LEFT JOIN stops a ON a.feed_id = x.feed_id AND a.stop_id = from_stop_id
            LEFT JOIN stops b ON b.feed_id = x.feed_id AND b.stop_id = to_stop_id""",
    }


def with_stats(body: str, order: str = "text", **extra: str) -> str:
    return with_views(body, **stats_views(order), **extra)
