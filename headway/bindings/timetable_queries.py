"""Queries on times, days, places and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.bindings import oracle as O
from headway.bindings.oracle import with_views
from headway.bindings.registry import query
from headway.bindings.views import Bound
from headway.functions.scalars import gtfs_seconds
from headway.operators import joins as N
from headway.operators import places as P
from headway.operators import rollups as U
from headway.operators import schedules as S
from headway.operators import service_days as D
from headway.operators import trip_rules as Q
from headway.operators import versions as V
from headway.session import kept, materialise

CHANGE_SECONDS = 120
HOUR = 3600
QUARTER = 900


def _seconds(c: str) -> str:
    return f"({O.minutes(c)} * 60 + TRY_CAST(split_part({c}, ':', 3) AS INT))"


def _stored_times(b: Bound) -> Bound:
    """The views with stop times joined once, for queries that read them several times."""
    b.stop_times = kept(b.stop_times, "stop-times")
    return b


def _timed(b: Bound, column: str, name: str):
    return b.stop_times.withColumn(name, gtfs_seconds(F.col(column)).cast("bigint"))


# --- as-of joins ---------------------------------------------------------------------

_DEPARTURES = f"""
    SELECT feed_id, stop_id, CAST({_seconds("departure_time")} AS BIGINT) AS leaves, min(trip_id) AS trip_id
    FROM stop_times WHERE {_seconds("departure_time")} IS NOT NULL GROUP BY 1, 2, 3"""


def _departures(b: Bound):
    return _timed(b, "departure_time", "leaves").select("feed_id", "stop_id", "leaves", "trip_id")


@query(
    "next_departures",
    with_views(
        f"""
        SELECT a.feed_id, a.trip_id, a.stop_sequence, a.stop_id, ready, d.leaves AS next_leaves,
               d.trip_id AS next_trip_id
        FROM (SELECT *, CAST({_seconds("arrival_time")} + {CHANGE_SECONDS} AS BIGINT) AS ready FROM stop_times) a
        ASOF LEFT JOIN departures d
            ON a.feed_id = d.feed_id AND a.stop_id = d.stop_id AND a.ready <= d.leaves""",
        departures=_DEPARTURES,
    ),
)
def _(b):
    b = _stored_times(b)
    arrivals = _timed(b, "arrival_time", "ready").select(
        "feed_id", "trip_id", "stop_sequence", "stop_id", (F.col("ready") + CHANGE_SECONDS).alias("ready")
    )
    return N.asof_join(
        arrivals, _departures(b), ["feed_id", "stop_id"], "ready", "leaves", HOUR, ["trip_id"]
    )


@query(
    "waits_since_last_departure",
    with_views(
        f"""
        SELECT feed_id, trip_id, stop_sequence, stop_id, arrives,
               CASE WHEN arrives - leaves <= 1800 THEN leaves END AS last_leaves,
               CASE WHEN arrives - leaves <= 1800 THEN other END AS last_trip_id
        FROM (SELECT a.*, d.leaves, d.trip_id AS other
              FROM (SELECT feed_id, trip_id, stop_sequence, stop_id,
                           CAST({_seconds("arrival_time")} AS BIGINT) AS arrives FROM stop_times) a
              ASOF LEFT JOIN departures d
                  ON a.feed_id = d.feed_id AND a.stop_id = d.stop_id AND a.arrives > d.leaves)""",
        departures=_DEPARTURES,
    ),
)
def _(b):
    b = _stored_times(b)
    arrivals = _timed(b, "arrival_time", "arrives").select("feed_id", "trip_id", "stop_sequence", "stop_id", "arrives")
    return N.asof_join(
        arrivals, _departures(b), ["feed_id", "stop_id"], "arrives", "leaves", HOUR, ["trip_id"],
        direction="backward", exact=False, within=1800, prefix="last_",
    )


@query(
    "timed_connections",
    with_views(
        f"""
        SELECT a.feed_id, a.trip_id, from_stop_id, to_stop_id, count(*) AS arrivals, count(d.leaves) AS connected,
               CAST(sum(d.leaves - ready) AS BIGINT) AS waited
        FROM (SELECT s.feed_id, s.trip_id, from_stop_id, to_stop_id,
                     CAST({_seconds("arrival_time")} + min_transfer_time AS BIGINT) AS ready
              FROM stop_times s JOIN transfers x ON x.feed_id = s.feed_id AND from_stop_id = s.stop_id
              WHERE min_transfer_time IS NOT NULL) a
        ASOF LEFT JOIN departures d
            ON a.feed_id = d.feed_id AND to_stop_id = d.stop_id AND a.ready <= d.leaves
        GROUP BY 1, 2, 3, 4""",
        departures=_DEPARTURES,
    ),
)
def _(b):
    b = _stored_times(b)
    # a row per trip and stop, and per transfer: each of their pairs is a row of the result
    arrivals = _timed(b, "arrival_time", "ready").groupBy(
        "feed_id", "trip_id", F.col("stop_id").alias("from_stop_id")
    ).agg(F.transform(F.collect_list(F.struct("ready")), lambda x: x["ready"]).alias("ready"))
    timed = b.transfers.where("min_transfer_time is not null")
    links = timed.groupBy("feed_id", "from_stop_id", "to_stop_id").agg(
        F.collect_list(F.col("min_transfer_time").cast("bigint")).alias("delays")
    )
    departures = _departures(b).withColumnRenamed("stop_id", "to_stop_id")
    found = N.asof_join(
        arrivals, departures, ["feed_id", "to_stop_id"], "ready", "leaves", HOUR, [],
        links=links, on=["feed_id", "from_stop_id"],
    )
    waits = F.zip_with("next_leaves", "ready", lambda leaves, ready: leaves - ready)
    known = found.withColumn("_waits", F.filter(waits, lambda w: w.isNotNull()))
    waited = F.aggregate("_waits", F.lit(0).cast("bigint"), lambda total, w: total + w)
    return known.select(
        "feed_id", "trip_id", "from_stop_id", "to_stop_id", F.size("ready").cast("bigint").alias("arrivals"),
        F.size("_waits").cast("bigint").alias("connected"), F.when(F.size("_waits") > 0, waited).alias("waited"),
    )


# --- intervals -----------------------------------------------------------------------

_RUNS = f"""
    SELECT t.feed_id, t.trip_id, route_id, CAST(min({_seconds("arrival_time")}) AS BIGINT) AS starts,
           CAST(max({_seconds("arrival_time")}) AS BIGINT) AS ends
    FROM stop_times s JOIN trips t ON s.feed_id = t.feed_id AND s.trip_id = t.trip_id GROUP BY 1, 2, 3"""


def _runs(b: Bound):
    spans = _timed(b, "arrival_time", "at").groupBy("feed_id", "trip_id").agg(
        F.min("at").alias("starts"), F.max("at").alias("ends")
    )
    return b.trips.select("feed_id", "trip_id", "route_id").join(spans, ["feed_id", "trip_id"])


@query(
    "trips_under_way",
    with_views(
        """
        SELECT p.feed_id, moment, count(*) AS trips, count(DISTINCT route_id) AS routes
        FROM (SELECT DISTINCT feed_id, starts // 900 * 900 AS moment FROM runs) p
        JOIN runs r ON p.feed_id = r.feed_id AND starts <= moment AND moment < ends
        GROUP BY 1, 2""",
        runs=_RUNS,
    ),
)
def _(b):
    def grid(c: str, to=F.ceil):
        return to(F.col(c) / QUARTER) * QUARTER

    # moments lie on a grid: runs that hold the same ones count together
    runs = _runs(b).groupBy(
        "feed_id", "route_id", grid("starts", F.floor).alias("moment"), grid("starts").alias("starts"),
        grid("ends").alias("ends"),
    ).agg(F.count(F.lit(1)).alias("trips"))
    runs = kept(runs, "runs")
    points = runs.select("feed_id", "moment").distinct()
    span = ["feed_id", "starts", "ends"]
    trips = runs.groupBy(*span).agg(F.sum("trips").alias("trips"), F.lit(0).cast("bigint").alias("routes"))
    # stretches of one route lie apart, so it counts once at any moment
    stretches = N.merged_intervals(
        runs.where("route_id is not null").select("route_id", *span).distinct(), ["feed_id", "route_id"],
        "starts", "ends",
    )
    routes = stretches.groupBy(*span).agg(F.lit(0).cast("bigint").alias("trips"), F.count(F.lit(1)).alias("routes"))
    pairs = N.points_in_intervals(
        points, trips.unionByName(routes), ["feed_id"], "moment", "starts", "ends", 2 * HOUR
    )
    return pairs.groupBy("feed_id", "moment").agg(F.sum("trips").alias("trips"), F.sum("routes").alias("routes"))


@query(
    "overlapping_runs",
    with_views(
        """
        SELECT a.feed_id, a.route_id, a.trip_id, a.starts, a.ends, b.trip_id AS other_trip_id,
               b.starts AS other_starts, b.ends AS other_ends,
               least(a.ends, b.ends) - greatest(a.starts, b.starts) AS overlap
        FROM runs a JOIN runs b ON a.feed_id = b.feed_id AND a.route_id = b.route_id AND a.trip_id < b.trip_id
            AND a.starts < b.ends AND b.starts < a.ends AND a.starts < a.ends AND b.starts < b.ends""",
        runs=_RUNS,
    ),
)
def _(b):
    return N.overlapping_intervals(
        _runs(b), ["feed_id", "route_id"], "trip_id", "starts", "ends", 4 * HOUR
    )


# --- service days --------------------------------------------------------------------

_FLAGS = "[" + ", ".join(D.DAYS) + "]"
_DATES = f"""
    SELECT feed_id, service_id, day AS date FROM (
        SELECT feed_id, service_id, CAST(unnest(generate_series(strptime(start_date, '%Y%m%d'),
                   strptime(end_date, '%Y%m%d'), INTERVAL 1 DAY)) AS DATE) AS day, {_FLAGS} AS flags
        FROM calendar)
    WHERE flags[isodow(day)] = 1
    UNION SELECT feed_id, service_id, CAST(strptime(date, '%Y%m%d') AS DATE) FROM calendar_dates
        WHERE exception_type = 1
    EXCEPT SELECT feed_id, service_id, CAST(strptime(date, '%Y%m%d') AS DATE) FROM calendar_dates
        WHERE exception_type = 2"""
# Zones with and without daylight saving, by feed; in one clocks change at midnight.
ZONES = {
    "0": "Europe/Paris", "1": "America/New_York", "2": "Asia/Kolkata", "3": "Australia/Sydney",
    "4": "America/Sao_Paulo",
}
_ZONES = "SELECT feed_id, CASE feed_id " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in ZONES.items()
) + " END AS time_zone FROM feeds"
_INSTANTS = f"""
    SELECT s.feed_id, s.trip_id, t.service_id, date,
           CAST(epoch(timezone(time_zone, CAST(date AS TIMESTAMP) + INTERVAL 12 HOUR)) - 43200
               + {_seconds("departure")} AS BIGINT) AS departure
    FROM starts s JOIN trips t ON s.feed_id = t.feed_id AND s.trip_id = t.trip_id
    JOIN zones z ON z.feed_id = s.feed_id
    JOIN dates d ON d.feed_id = t.feed_id AND d.service_id = t.service_id
    WHERE {_seconds("departure")} IS NOT NULL"""
_STARTS = O.stats_views()["starts"]


def _zones(b: Bound):
    names = F.create_map(*[F.lit(x) for item in ZONES.items() for x in item])
    return b.feeds.select("feed_id", F.try_element_at(names, F.col("feed_id")).alias("time_zone"))


def _instants(b: Bound):
    first = S.first_stop_per_trip(b.stop_times, ("stop_id", "departure_time"))
    dates = D.service_dates(b.calendar, b.calendar_dates)
    return D.departure_instants(first, b.trips, dates, _zones(b))


@query("service_dates", with_views(f"SELECT feed_id, service_id, CAST(date AS VARCHAR) AS date FROM ({_DATES})"))
def _(b):
    dates = D.service_dates(b.calendar, b.calendar_dates)
    return dates.withColumn("date", F.col("date").cast("string"))


@query(
    "departure_instants",
    with_views(
        "SELECT feed_id, trip_id, service_id, CAST(date AS VARCHAR) AS date, departure FROM instants",
        starts=_STARTS, dates=_DATES, zones=_ZONES, instants=_INSTANTS,
    ),
)
def _(b):
    return _instants(b).withColumn("date", F.col("date").cast("string"))


@query(
    "runs_per_day",
    with_views(
        """
        SELECT i.feed_id, CAST(CAST(timezone(time_zone, to_timestamp(departure)) AS DATE) AS VARCHAR) AS day,
               count(*) AS runs, count(DISTINCT service_id) AS services
        FROM instants i JOIN zones z ON z.feed_id = i.feed_id GROUP BY 1, 2""",
        starts=_STARTS, dates=_DATES, zones=_ZONES, instants=_INSTANTS,
    ),
)
def _(b):
    return D.runs_per_day(_instants(b), _zones(b)).withColumn("day", F.col("day").cast("string"))


# --- places --------------------------------------------------------------------------

# Customers as stops all over the globe, poles and date line included.
_PLACES = """
    SELECT CAST(c_nationkey % 5 AS STRING) AS feed_id, CAST(c_custkey AS STRING) AS stop_id,
           (c_custkey * 7919 % 18001) / 100.0D - 90 AS stop_lat,
           (c_custkey * 104729 % 36001) / 100.0D - 180 AS stop_lon
    FROM customer"""
NEAR = 400_000.0
_ACROSS = """pow(sin((radians(b.stop_lat) - radians(a.stop_lat)) / 2), 2) + cos(radians(a.stop_lat))
    * cos(radians(b.stop_lat)) * pow(sin((radians(b.stop_lon) - radians(a.stop_lon)) / 2), 2)"""
_METRES = f"2 * 6371000 * asin(sqrt(least({_ACROSS}, 1)))"


@query(
    "near_stops",
    with_views(
        f"""
        SELECT a.feed_id, a.stop_id, b.stop_id AS other_stop_id, CAST(round({_METRES}) AS BIGINT) AS metres
        FROM places a JOIN places b ON a.feed_id = b.feed_id AND a.stop_id < b.stop_id
        WHERE {_METRES} <= {NEAR}""",
        places=_PLACES.replace("100.0D", "100.0::DOUBLE"),
    ),
)
def _(b):
    places = b.spark.sql(_PLACES.replace("FROM customer", "FROM {customer}"), customer=b.raw("customer"))
    return P.near_stops(places, NEAR).withColumn("metres", F.round("metres").cast("bigint"))


# --- frames along a trip ---------------------------------------------------------------

# Most stop times of the bound tables name stops of other feeds; here every third stop has no position.
_POSITIONS = """
    SELECT DISTINCT s.feed_id, s.stop_id, stop_lat, stop_lon FROM stop_times s JOIN stops p ON p.stop_id = s.stop_id
    WHERE CAST(s.stop_id AS BIGINT) % 3 <> 0"""
_LINE = "PARTITION BY feed_id, trip_id ORDER BY stop_sequence, stop_id, arrival_time, departure_time NULLS FIRST"
_FRAMES = f"""
    WITH placed AS (
        SELECT s.*, stop_lat, stop_lon,
               CAST(coalesce({_seconds("arrival_time")}, {_seconds("departure_time")}) AS BIGINT) AS seconds
        FROM stop_times s LEFT JOIN positions p ON p.feed_id = s.feed_id AND p.stop_id = s.stop_id),
    stepped AS (
        SELECT *, lag(seconds) OVER w AS last_seconds, lag(stop_sequence) OVER w AS before_sequence,
               lag(stop_lat) OVER w AS last_lat, lag(stop_lon) OVER w AS last_lon
        FROM placed WINDOW w AS ({_LINE})),
    measured AS (
        SELECT *, seconds - last_seconds AS waited,
               pow(sin((radians(stop_lat) - radians(last_lat)) / 2), 2) + cos(radians(last_lat))
                   * cos(radians(stop_lat)) * pow(sin((radians(stop_lon) - radians(last_lon)) / 2), 2) AS across,
               2 * 6371000 * asin(sqrt(CASE WHEN across > 1 THEN 1 ELSE across END)) AS metres
        FROM stepped)
    SELECT feed_id, trip_id, stop_sequence, stop_id, seconds, before_sequence, waited, metres,
           CASE WHEN waited > 0 THEN metres / waited END AS speed,
           sum(metres) OVER (w ROWS UNBOUNDED PRECEDING) AS travelled,
           CAST(1 + sum(CASE WHEN waited > {Q.LONG_GAP} THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING)
               AS BIGINT) AS session,
           CASE WHEN seconds IS NOT NULL THEN count(seconds) OVER (PARTITION BY feed_id, trip_id
               ORDER BY seconds RANGE BETWEEN 1 FOLLOWING AND {Q.SOON} FOLLOWING) END AS ahead
    FROM measured WINDOW w AS ({_LINE})"""
_PROBLEMS = f"""
    SELECT feed_id, trip_id, count(*) AS stops, count(*) FILTER (waited < 0) AS times_fall_back,
           count(*) FILTER (stop_sequence = before_sequence) AS repeated_sequence,
           count(*) FILTER (speed > {Q.FASTEST}) AS too_fast, max(session) AS sessions,
           coalesce(max(travelled), 0) AS travelled, max(waited) AS longest_wait
    FROM frames GROUP BY 1, 2"""


def _frames(b: Bound):
    named = b.stops.select("stop_id", "stop_lat", "stop_lon").where("bigint(stop_id) % 3 <> 0")
    b = _stored_times(b)
    positions = b.stop_times.select("feed_id", "stop_id").distinct().join(named, "stop_id")
    return Q.trip_frames(b.stop_times, positions, ("stop_id", "arrival_time", "departure_time"))


@query(
    "trip_frames",
    with_views(
        """
        SELECT feed_id, trip_id, stop_sequence, stop_id, seconds, waited, CAST(round(metres) AS BIGINT) AS metres,
               CAST(round(speed * 100) AS BIGINT) AS speed, CAST(round(travelled) AS BIGINT) AS travelled,
               session, ahead
        FROM frames""",
        positions=_POSITIONS, frames=_FRAMES,
    ),
)
def _(b):
    return _frames(b).select(
        "feed_id", "trip_id", "stop_sequence", "stop_id", "seconds", "waited",
        F.round("metres").cast("bigint").alias("metres"),
        F.round(F.col("speed") * 100).cast("bigint").alias("speed"),
        F.round("travelled").cast("bigint").alias("travelled"), "session", "ahead",
    )


@query(
    "trip_problems",
    with_views(
        """
        SELECT feed_id, trip_id, stops, times_fall_back, repeated_sequence, too_fast, sessions, longest_wait,
               CAST(round(travelled / 1000) AS BIGINT) AS kilometres FROM problems""",
        positions=_POSITIONS, frames=_FRAMES, problems=_PROBLEMS,
    ),
)
def _(b):
    return Q.trip_problems(_frames(b)).withColumn("kilometres", F.round("kilometres").cast("bigint"))


def _rule(rule: str, table: str, broken: str) -> str:
    return (
        f"SELECT feed_id, '{rule}' AS rule, count(*) FILTER ({broken}) AS broken, count(*) AS checked"
        f" FROM {table} GROUP BY 1"
    )


@query(
    "timetable_rules",
    with_views(
        "\nUNION ALL ".join([
            _rule("times_fall_back", "problems", "times_fall_back > 0"),
            _rule("repeated_sequence", "problems", "repeated_sequence > 0"),
            _rule("too_fast", "problems", "too_fast > 0"),
            _rule("single_stop", "problems", "stops = 1"),
            _rule("stop_at_zero", "stops", "stop_lat = 0 AND stop_lon = 0"),
            _rule("stop_off_the_globe", "stops", "abs(stop_lat) > 90 OR abs(stop_lon) > 180"),
            _rule("route_without_name", "routes",
                  "coalesce(route_short_name, '') = '' AND coalesce(route_long_name, '') = ''"),
            _rule("route_without_trips", "routes",
                  "NOT EXISTS (SELECT 1 FROM trips t WHERE t.feed_id = routes.feed_id AND t.route_id = routes.route_id)"),
            _rule("service_on_no_day", "calendar", " AND ".join(f"{d} <> 1" for d in D.DAYS)),
            _rule("service_ends_before_start", "calendar", "end_date < start_date"),
            _rule("transfer_without_time", "transfers", "transfer_type = 2 AND min_transfer_time IS NULL"),
        ]),
        positions=_POSITIONS, frames=_FRAMES, problems=_PROBLEMS,
    ),
)
def _(b):
    tables = {name: getattr(b, name) for name in ("routes", "trips", "stops", "calendar", "transfers")}
    return Q.timetable_rules(Q.trip_problems(_frames(b)), tables)


# --- sketches ----------------------------------------------------------------------------

_HEADWAYS = f"""
    SELECT * FROM (
        SELECT s.feed_id, route_id, stop_id, CAST({_seconds("departure_time")} AS BIGINT) - lag(
                   CAST({_seconds("departure_time")} AS BIGINT)) OVER (
                   PARTITION BY s.feed_id, route_id, stop_id ORDER BY {_seconds("departure_time")}, s.trip_id) AS headway
        FROM stop_times s JOIN trips t ON t.feed_id = s.feed_id AND t.trip_id = s.trip_id
        WHERE {_seconds("departure_time")} IS NOT NULL)
    WHERE headway IS NOT NULL"""


@query(
    "headway_rollup",
    with_views(
        "\nUNION ALL ".join(
            f"SELECT '{level}' AS level, {feed} AS feed_id, {route} AS route_id, count(*) AS n,"
            f" min(headway) AS least, max(headway) AS most, true AS close FROM headways GROUP BY 1, 2, 3"
            for level, feed, route in (
                ("route", "feed_id", "route_id"), ("feed", "feed_id", "''"), ("network", "''", "''")
            )
        ),
        headways=_HEADWAYS,
    ),
)
def _(b):
    """All levels merged from the stored sketches of stops; ``close`` tells whether every
    quantile lies within the error of its rank among all headways, and the stops within 10 %."""
    rows = materialise(U.headways(b.stop_times, b.trips))
    sketches = materialise(U.stop_sketches(rows))
    levels = None
    for level in ("route", "feed", "network"):
        by = list(U.LEVELS[level])
        sketches = U.merged(sketches, by)
        told = U.quantiles(sketches, by)
        marks = [f"p{round(q * 100)}" for q in U.QUANTILES]
        joined = rows.join(told, by) if by else _beside(rows, told)
        close = F.lit(True)
        aggregates = [F.countDistinct("stop_id").alias("exact")]
        for q, mark in zip(U.QUANTILES, marks):
            aggregates += [
                F.avg((F.col("headway") < F.col(mark)).cast("double")).alias(f"_{mark}_below"),
                F.avg((F.col("headway") <= F.col(mark)).cast("double")).alias(f"_{mark}_upto"),
            ]
            # groups of few rows are held exactly, up to the rounding of a rank to a row
            slack = U.RANK_ERROR + 1 / F.col("n")
            close = close & (F.col(f"_{mark}_below") <= q + slack) & (F.col(f"_{mark}_upto") >= q - slack)
        close = close & (F.abs(F.col("stops") - F.col("exact")) <= 0.1 * F.col("exact"))
        checked = joined.groupBy(*by, "n", "least", "most", "stops").agg(*aggregates)
        part = checked.select(
            F.lit(level).alias("level"),
            (F.col("feed_id") if "feed_id" in by else F.lit("")).alias("feed_id"),
            (F.col("route_id") if "route_id" in by else F.lit("")).alias("route_id"),
            "n", "least", "most", close.alias("close"),
        )
        levels = part if levels is None else levels.unionByName(part)
    return levels


def _beside(rows, one):
    """The columns of a one-row result beside every row, as a scalar subquery."""
    told = one.select(F.struct(*one.columns)).scalar()
    return rows.withColumn("_one", told).select(*rows.columns, "_one.*")


# --- versions ----------------------------------------------------------------------------

COLUMNS = ["feed_id", "trip_id", "route_id", "service_id", "trip_headsign"]
# the later version: some trips gone, some with another sign or service, some twice, some new
_LATER = """
    SELECT feed_id, trip_id, route_id,
           CASE WHEN _pos % 53 = 0 THEN service_id || '+' ELSE service_id END AS service_id,
           CASE WHEN _pos % 47 = 0 THEN NULL WHEN _pos % 31 = 0 THEN 'Depot' ELSE trip_headsign END AS trip_headsign
    FROM {trips} WHERE _pos % 41 <> 0
    UNION ALL SELECT feed_id, trip_id, route_id, service_id, trip_headsign FROM {trips} WHERE _pos % 37 = 0
    UNION ALL SELECT feed_id, 'new-' || trip_id, route_id, service_id, trip_headsign FROM {trips} WHERE _pos % 43 = 0"""
_NAMES = ", ".join(COLUMNS)
_OLD = f"SELECT {_NAMES} FROM trips UNION ALL SELECT {_NAMES} FROM trips WHERE _pos % 29 = 0"


def _versions(b: Bound):
    old = b.trips.unionByName(b.trips.where("_pos % 29 = 0")).select(*COLUMNS)
    return old, b.spark.sql(_LATER, trips=b.trips)


def _with_versions(body: str) -> str:
    return with_views(body, old=_OLD, later=_LATER.replace("{trips}", "trips"))


_CHANGES = f"""
    SELECT *, 'added' AS change, count(*) AS n FROM (SELECT {_NAMES} FROM later EXCEPT ALL SELECT * FROM old) GROUP BY ALL
    UNION ALL
    SELECT *, 'removed', count(*) FROM (SELECT * FROM old EXCEPT ALL SELECT {_NAMES} FROM later) GROUP BY ALL"""


@query("row_changes", _with_versions(_CHANGES))
def _(b):
    return V.row_changes(*_versions(b), COLUMNS)


@query(
    "kept_rows",
    _with_versions(
        f"SELECT *, count(*) AS n FROM (SELECT {_NAMES} FROM later INTERSECT ALL SELECT * FROM old) GROUP BY ALL"
    ),
)
def _(b):
    return V.kept_rows(*_versions(b), COLUMNS)


@query("apply_changes", _with_versions(f"SELECT {_NAMES} FROM later"))
def _(b):
    old, later = _versions(b)
    return V.apply_changes(old, V.row_changes(old, later, COLUMNS), COLUMNS)


@query(
    "changed_trips",
    _with_versions(
        f"""
        SELECT feed_id, trip_id, added, removed,
               CASE WHEN removed = 0 THEN 'added' WHEN added = 0 THEN 'removed' ELSE 'changed' END AS kind,
               CASE WHEN added = 1 AND removed = 1 THEN concat_ws('|',
                   CASE WHEN route <> 1 THEN 'route_id' END, CASE WHEN service <> 1 THEN 'service_id' END,
                   CASE WHEN sign <> 1 THEN 'trip_headsign' END) ELSE '' END AS columns
        FROM (SELECT feed_id, trip_id, CAST(coalesce(sum(n) FILTER (change = 'added'), 0) AS BIGINT) AS added,
                     CAST(coalesce(sum(n) FILTER (change = 'removed'), 0) AS BIGINT) AS removed,
                     count(DISTINCT coalesce(route_id, '~')) AS route, count(DISTINCT coalesce(service_id, '~')) AS service,
                     count(DISTINCT coalesce(trip_headsign, '~')) AS sign
              FROM ({_CHANGES}) GROUP BY 1, 2)"""
    ),
)
def _(b):
    changes = V.row_changes(*_versions(b), COLUMNS)
    found = V.changed_keys(changes, ["feed_id", "trip_id"], COLUMNS)
    return found.withColumn("columns", F.array_join("columns", "|"))
