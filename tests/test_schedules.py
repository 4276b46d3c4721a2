import re

import pytest
from conftest import rows

from headway.operators import schedules as S
from headway.operators import summaries as M

TRIPS = [("f", f"T{i}", "R", h) for i, h in enumerate(["b", "a", None, "c", "a", "d", "e", "f"])]
TIMES = [
    # trip, departure, stop, sequence, position
    ("T0", "04:30:00", "A", 1, 1), ("T0", "05:00:00", "B", 2, 2),
    ("T1", "9:00:00", "A", 5, 4), ("T1", "8:00:00", "B", 5, 3),  # tie: the first row counts
    ("T2", "25:15:00", "C", 1, 5),
    ("T3", None, "C", 1, 6), ("T3", "01:00:00", "C", 2, 7),  # no departure at the first stop
    ("T4", "  ", "D", 1, 8),
    ("T5", "02:00:00", "E", None, 9),  # no sequence at all
    ("T6", "23:59:00", None, 1, 10), ("T6", "00:10:00", "E", None, 11),
    ("T9", "00:00:00", "Z", 1, 12),  # unknown trip
]


@pytest.fixture(scope="module")
def tables(spark):
    trips = spark.createDataFrame(
        TRIPS + [("f", "T8", None, "x"), ("g", "T0", "R", None)],
        "feed_id string, trip_id string, route_id string, trip_headsign string",
    )
    times = spark.createDataFrame(
        [("f", *t) for t in TIMES],
        "feed_id string, trip_id string, departure_time string, stop_id string,"
        " stop_sequence int, _pos int",
    )
    return trips, times


def test_first_stop_per_trip(tables):
    found = S.first_stop_per_trip(tables[1])
    assert rows(found.where("trip_id <> 'T9'"), "trip_id", "_pos") == [
        ("T0", 1), ("T1", 3), ("T2", 5), ("T3", 6), ("T4", 8), ("T6", 10)
    ]


def test_route_schedules(tables):
    found = {r.feed_id: r for r in S.route_schedules(*tables).collect()}
    f = found["f"]
    # as text 8:00:00 lies behind 25:15:00
    assert (f.first_departure, f.last_departure) == ("04:30:00", "8:00:00")
    assert (f.trip_count, f.stop_count) == (8, 5)
    assert f.headsigns == ["a", "b", "c", "d", "e"]
    g = found["g"]
    assert (g.trip_count, g.stop_count, g.first_departure, g.headsigns) == (1, 0, None, [])


def test_route_schedules_by_time(tables):
    (f,) = S.route_schedules(*tables, order="seconds").where("feed_id = 'f'").collect()
    assert (f.first_departure, f.last_departure) == ("04:30:00", "25:15:00")


def test_stop_times_are_shuffled_once(spark, tables):
    joins = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(joins)
    spark.conf.set(joins, "-1")  # as large tables have it
    try:
        plan = S.route_schedules(*tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(joins, before)
    # one exchange of stop times by trip, one of the trips they meet
    by_trip = [x for x in plan.splitlines() if "hashpartitioning(feed_id" in x and "trip_id" in x]
    by_trip = [x for x in by_trip if "route_id" not in x]
    assert len(by_trip) == 2, plan


def test_filters(spark):
    routes = spark.createDataFrame(
        [("f", "1", "04:00:00", "23:30:00", "1", 2), ("f", "2", "9:00:00", "10:00:00", "", 0),
         ("f", "3", None, "23:00", "3", 1)],
        "feed_id string, route_id string, first_departure string, last_departure string,"
        " route_short_name string, trip_count int",
    )
    assert rows(S.scheduled_routes(routes), "route_id") == [("1",)]
    assert rows(S.scheduled_routes(routes, need_names=False), "route_id") == [("1",)]
    assert rows(S.early_routes(routes), "route_id") == [("1",)]
    assert rows(S.late_routes(routes), "route_id") == [("1",)]
    assert rows(S.early_routes(routes, "09:30", order="seconds"), "route_id") == [("1",), ("2",)]


def test_statistics_of_a_feed(summary):
    (a,) = summary.feed_stats.where("feed_id = '0029'").collect()
    assert (a.total_routes, a.total_stops, a.total_trips) == (3, 6, 5)
    assert (a.avg_stops_per_route, a.avg_trips_per_route) == (2.0, 1.7)
    assert a.by_type == {1: 1, 3: 1, 11: 1}
    assert (a.weekday_services, a.weekend_services, a.calendar_dates_count) == (1, 1, 2)
    assert (a.range_start, a.range_end) == ("20260101", "20261231")
    assert (a.station_count, a.total_transfers) == (1, 3)
    # the exceptions' dates stand in for a missing calendar
    (b,) = summary.feed_stats.where("feed_id = 'b'").collect()
    assert (b.weekday_services, b.range_start, b.range_end) == (0, "20260101", "20260303")
    routes = {r.route_id: r for r in summary.route_stats.where("feed_id = '0029'").collect()}
    r1 = routes["R1"]
    assert (r1.trip_count, r1.stop_count) == (3, 3)
    assert (r1.first_departure, r1.last_departure) == ("05:30:00", "25:15:00")
    assert r1.headsigns == ["Centre", "Harbour"]


def test_published_averages(spark):
    ids = spark.range(133).selectExpr("'d' as feed_id", "string(id) as route_id")
    stops = spark.range(11177).selectExpr("'d' as feed_id")
    trips = ids.selectExpr("*", "if(route_id = '0', 37802, 0) as trip_count")
    (n,) = M.network_stats(ids, stops, trips).collect()
    assert (n.avg_stops_per_route, n.avg_trips_per_route) == (84.0, 284.2)


def test_listed_routes_only(spark):
    routes = spark.range(60).selectExpr("'f' as feed_id", "string(id) as route_id", "id as _pos")
    stats = routes.selectExpr("*", "10 as trip_count")
    stops = routes.limit(6)
    (everything,) = M.network_stats(routes, stops, stats).collect()
    assert (everything.total_trips, everything.avg_trips_per_route) == (600, 10.0)
    (listed,) = M.network_stats(routes, stops, stats, scope="listed").collect()
    assert (listed.total_trips, listed.avg_trips_per_route) == (500, 8.3)


def test_no_routes(spark):
    none = spark.createDataFrame([], "feed_id string, route_id string, trip_count int, _pos int")
    stops = spark.createDataFrame([("f",)], "feed_id string")
    (n,) = M.network_stats(none, stops, none).collect()
    assert (n.total_routes, n.total_stops, n.avg_stops_per_route) == (0, 1, 0.0)


def test_transfer_names(spark):
    transfers = spark.createDataFrame([("f", "1", "9", 2)], "feed_id string, from_stop_id string,"
                                      " to_stop_id string, transfer_type int")
    stops = spark.createDataFrame([("f", "1", "One"), ("g", "9", "Nine")],
                                  "feed_id string, stop_id string, stop_name string")
    for missing, shown in (("blank", ""), ("id", "9")):
        (t,) = M.transfers_with_names(transfers, stops, missing).collect()
        assert (t.from_stop_name, t.to_stop_name) == ("One", shown)


def test_document(summary):
    (a,) = summary.nested().where("feed_id = '0029'").collect()
    assert a.provider == "Alpha" and a.agency[0].agency_timezone == "Europe/Paris"
    assert [r.route_id for r in a.route_summary.routes] == ["R1", "R2", "R3"]
    assert a.route_summary.routes[1].route_long_name == ""
    assert [s.stop_id for s in a.stop_summary.stations] == ["S0"]
    assert a.stop_summary.by_location_type == {0: 3, 1: 1}
    assert len(a.stop_summary.sample_stops) == 6
    names = {(t.from_stop_name, t.to_stop_name) for t in a.transfer_summary.sample_transfers}
    assert names == {("Platform 1", "Market"), ("Market", "Hill Foot"), ("Hill Foot", "")}
    assert a.calendar_summary.date_range == ["20260101", "20261231"]


def test_sorts_by_route_start_with_the_route(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips = spark.createDataFrame(
            [("1", "T1", "R1", "Hill")], "feed_id string, trip_id string, route_id string,"
            " trip_headsign string",
        )
        times = spark.createDataFrame(
            [("1", "T1", 1, "S1", "08:00:00", 0)], "feed_id string, trip_id string,"
            " stop_sequence int, stop_id string, departure_time string, _pos int",
        )
        found = S.route_schedules(trips, times)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sorts = [re.findall(r"(\w+)#", x) for x in plan.splitlines() if re.search(r" Sort \[", x)]
    by_route = [keys for keys in sorts if "route_id" in keys]
    assert by_route and all(keys[0] == "route_id" for keys in by_route)
    assert found.columns[:2] == ["feed_id", "route_id"]
    assert found.first()[:4] == ("1", "R1", 1, 1)
