"""Joins by order, service days, near stops, frames along trips, versions and sketches."""

import collections
import datetime
import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.operators import joins as N
from headway.operators import places as P
from headway.operators import rollups as U
from headway.operators import service_days as D
from headway.operators import trip_rules as Q
from headway.operators import versions as V


@pytest.fixture(scope="module")
def sides(spark):
    r = random.Random(7)
    key = lambda: r.choice(["hot"] * 6 + ["a", "b", None])
    time = lambda: r.choice([None] + list(range(-30, 90)) * 2)
    left = [(i, key(), time()) for i in range(150)]
    right = [(f"r{i % 40}", key(), time()) for i in range(60)]
    return (
        left, right,
        spark.createDataFrame(left, "n int, k string, t bigint").repartition(4),
        spark.createDataFrame(right, "v string, k string, u bigint").repartition(3),
    )


@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("within", [None, 5])
def test_asof_join(sides, direction, exact, within):
    left, right, a, b = sides
    sign = 1 if direction == "forward" else -1

    def nearest(k, t):
        if k is None or t is None:
            return None, None
        able = [
            (sign * (u - t), v, u) for v, q, u in right
            if q == k and u is not None and (sign * (u - t) > 0 or exact and u == t)
        ]
        if not able or within is not None and min(able)[0] > within:
            return None, None
        _, v, u = min(able)
        return u, v

    want = sorted(((n, k, t, *nearest(k, t)) for n, k, t in left), key=repr)
    for width in (1, 7, 1000):
        found = N.asof_join(a, b, ["k"], "t", "u", width, ["v"], direction, exact, within)
        assert rows(found, "n", "k", "t", "next_u", "next_v") == want, width


def test_asof_join_of_nothing(sides):
    left, _, a, b = sides
    assert N.asof_join(a.where("1 = 0"), b, ["k"], "t", "u", 10, ["v"]).count() == 0
    found = N.asof_join(a, b.where("1 = 0"), ["k"], "t", "u", 10, ["v"])
    assert found.count() == len(left) and found.where("next_u is not null").count() == 0


def test_a_hot_stop_is_cut_by_time(spark):
    a = spark.range(20_000).select(F.lit("x").alias("k"), F.col("id").alias("t"))
    b = spark.range(0, 20_000, 50).select(F.lit("x").alias("k"), F.col("id").alias("u"), F.col("id").alias("v"))
    found = N.asof_join(a, b, ["k"], "t", "u", 100, ["v"])
    assert found.where("next_u <> ceil(t / 50) * 50").count() == 0
    assert found.where("next_u is null").count() == 49
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_intervals(spark):
    r = random.Random(3)
    spans = [(i, r.choice("ab"), s := r.randint(-40, 60), s + r.randint(-3, 30)) for i in range(60)]
    points = [(r.choice("abc"), r.randint(-50, 100)) for _ in range(50)]
    a = spark.createDataFrame(spans, "id int, k string, s bigint, e bigint")
    p = spark.createDataFrame(points, "k string, t bigint")
    held = sorted((k, t, i) for k, t in points for i, q, s, e in spans if q == k and s <= t < e)
    shared = sorted(
        (i, j, min(e, f) - max(s, t))
        for i, k, s, e in spans for j, q, t, f in spans if i < j and k == q and max(s, t) < min(e, f)
    )
    for width in (1, 9, 500):
        assert rows(N.points_in_intervals(p, a, ["k"], "t", "s", "e", width), "k", "t", "id") == sorted(held, key=repr)
        found = N.overlapping_intervals(a, ["k"], "id", "s", "e", width)
        assert rows(found, "id", "other_id", "overlap") == sorted(shared, key=repr)


def test_service_dates(spark):
    days = "monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int"
    calendar = spark.createDataFrame(
        [
            ("f", "wd", 1, 1, 1, 1, 1, 0, 0, "20260105", "20260112"),
            ("f", "we", 0, 0, 0, 0, 0, 1, None, "20260105", "20260112"),
            ("f", "back", 1, 1, 1, 1, 1, 1, 1, "20260110", "20260105"),
            ("f", "bad", 1, 1, 1, 1, 1, 1, 1, "2026-01-01", "20260105"),
            ("f", None, 1, 1, 1, 1, 1, 1, 1, "20260105", "20260105"),
        ],
        f"feed_id string, service_id string, {days}, start_date string, end_date string",
    )
    exceptions = spark.createDataFrame(
        [
            ("f", "wd", "20260106", 2), ("f", "wd", "20260111", 1), ("f", "wd", "20260107", 1),
            ("f", "only", "20260301", 1), ("f", "both", "20260301", 1), ("f", "both", "20260301", 2),
            ("f", "we", "20260111", 3), ("f", "we", "x", 1), ("g", "wd", "20260106", None),
        ],
        "feed_id string, service_id string, date string, exception_type int",
    )
    found = collections.defaultdict(list)
    for r in D.service_dates(calendar, exceptions).orderBy("date").collect():
        found[r.service_id].append(r.date.strftime("%m%d"))
    assert found == {
        "wd": ["0105", "0107", "0108", "0109", "0111", "0112"], "we": ["0110"], "only": ["0301"],
    }


def test_departures_on_days_of_change(spark):
    """Times count from noon minus twelve hours, against the zone database of Python."""
    from zoneinfo import ZoneInfo

    zones = ["Europe/Paris", "America/Sao_Paulo", "Asia/Kolkata", "Australia/Lord_Howe"]
    dates = ["2026-03-28", "2026-03-29", "2026-10-25", "1995-10-15", "2026-04-05"]
    cases = [(z, d, s) for z in zones for d in dates for s in (0, 2 * 3600, 30 * 3600)]
    df = spark.createDataFrame(cases, "zone string, day string, seconds int").withColumn(
        "at", D.instant(F.to_date("day"), F.col("seconds"), F.col("zone"))
    )
    for r in df.collect():
        noon = datetime.datetime.fromisoformat(f"{r.day}T12:00:00").replace(tzinfo=ZoneInfo(r.zone))
        assert r.at == int(noon.timestamp()) - 12 * 3600 + r.seconds, r


def test_runs_without_time_service_or_zone(spark):
    first = spark.createDataFrame(
        [("f", "a", "25:10:00"), ("f", "b", ""), ("f", "c", "5:00:00"), ("g", "a", "5:00:00")],
        "feed_id string, trip_id string, departure_time string",
    )
    trips = spark.createDataFrame(
        [("f", "a", "s"), ("f", "b", "s"), ("f", "c", None), ("g", "a", "s")],
        "feed_id string, trip_id string, service_id string",
    )
    dates = spark.sql("select 'f' feed_id, 's' service_id, date'2026-07-01' date union all select 'g', 's', date'2026-07-01'")
    zones = spark.createDataFrame([("f", "Europe/Paris"), ("g", None)], "feed_id string, time_zone string")
    runs = D.departure_instants(first, trips, dates, zones)
    (run,) = runs.collect()
    assert datetime.datetime.fromtimestamp(run.departure, datetime.UTC).isoformat() == "2026-07-01T23:10:00+00:00"
    (day,) = D.runs_per_day(runs, zones).collect()
    assert (str(day.day), day.runs, day.services) == ("2026-07-02", 1, 1)


def metres(a, b):
    (p, q), (r, s) = ((math.radians(x), math.radians(y)) for x, y in (a, b))
    h = math.sin((r - p) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((s - q) / 2) ** 2
    return 2 * P.EARTH * math.asin(math.sqrt(min(1, h)))


@pytest.mark.parametrize("reach", [300.0, 50_000.0, 2_000_000.0])
def test_near_stops(spark, reach):
    r = random.Random(5)
    centres = [(48.0, 2.0), (89.999, 10.0), (-90.0, 0.0), (0.0, 180.0), (65.0, -179.9999), (88.0, 100.0)]
    spread = math.degrees(reach / P.EARTH) * 1.5
    places = []
    for i in range(140):
        lat, lon = r.choice(centres)
        lat = max(-90.0, min(90.0, lat + r.uniform(-spread, spread)))
        wide = min(180.0, spread / max(0.0005, math.cos(math.radians(lat))))
        lon = (lon + r.uniform(-wide, wide) + 180) % 360 - 180
        places.append((r.choice("fg"), f"{i:03d}", lat, lon))
    df = spark.createDataFrame(
        [*places, ("f", "off", 91.0, 0.0), ("f", "none", None, 0.0), ("f", None, 48.0, 2.0)],
        "feed_id string, stop_id string, stop_lat double, stop_lon double",
    )
    want = sorted(
        (f, i, j) for f, i, *a in places for g, j, *b in places if f == g and i < j and metres(a, b) <= reach
    )
    assert want
    for dense in (2000, 3):
        assert rows(P.near_stops(df, reach, dense=dense), "feed_id", "stop_id", "other_stop_id") == want


def test_frames_along_a_trip(spark):
    stops = spark.createDataFrame(
        [("f", "a", 0.0, 0.0), ("f", "b", 0.0, 1.0), ("f", "c", None, None)],
        "feed_id string, stop_id string, stop_lat double, stop_lon double",
    )
    times = spark.createDataFrame(
        [
            ("f", "t", 1, "a", "08:00:00", None), ("f", "t", 2, "b", "", "08:10:00"),
            ("f", "t", 2, "c", "08:05:00", None), ("f", "t", 5, "a", "10:05:01", None),
            ("f", "t", 9, "x", None, None), ("f", "one", 1, "a", "08:00:00", None),
        ],
        "feed_id string, trip_id string, stop_sequence int, stop_id string, arrival_time string, departure_time string",
    )
    frames = Q.trip_frames(times, stops)
    found = [r for r in frames.where("trip_id = 't'").orderBy("stop_sequence", "stop_id").collect()]
    degree = math.radians(1) * P.EARTH
    assert [r.waited for r in found] == [None, 600, -300, 7201, None]
    assert [r.session for r in found] == [1, 1, 1, 2, 2]
    assert found[1].metres == pytest.approx(degree) and found[2].metres is None
    assert found[1].speed == pytest.approx(degree / 600) and found[2].speed is None
    assert found[3].travelled == pytest.approx(degree)
    assert [r.ahead for r in found] == [2, 0, 1, 0, None]
    assert frames._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(feed_id, trip_id") <= 1
    problems = {r.trip_id: r for r in Q.trip_problems(frames).collect()}
    p = problems["t"]
    assert (p.stops, p.times_fall_back, p.repeated_sequence, p.too_fast, p.sessions) == (5, 1, 1, 1, 2)
    assert problems["one"].kilometres == 0 and problems["one"].longest_wait is None
    rules = {r.rule: (r.broken, r.checked) for r in Q.timetable_rules(Q.trip_problems(frames), {"stops": stops}).collect()}
    assert rules == {
        "times_fall_back": (1, 2), "repeated_sequence": (1, 2), "too_fast": (1, 2), "single_stop": (1, 2),
        "stop_at_zero": (1, 3), "stop_off_the_globe": (1, 3),
    }


def test_versions(spark):
    r = random.Random(2)
    make = lambda: [(r.choice(["k1", "k2", None]), r.choice(["x", "y", None]), r.choice([1, 2])) for _ in range(40)]
    schema, columns = "k string, v string, n int", ["k", "v", "n"]
    old, new = make(), make()
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    count, later = collections.Counter(old), collections.Counter(new)
    # a column of the table may have the name of a count: n is given back as it is
    a, b = a.withColumnRenamed("n", "m"), b.withColumnRenamed("n", "m")
    columns = ["k", "v", "m"]
    changes = V.row_changes(a, b, columns)
    want = [(*x, "added", n) for x, n in (later - count).items()] + [(*x, "removed", n) for x, n in (count - later).items()]
    assert rows(changes) == sorted(want, key=repr)
    assert rows(V.kept_rows(a, b, columns)) == sorted(((*x, n) for x, n in (count & later).items()), key=repr)
    assert rows(V.apply_changes(a, changes, columns)) == sorted(new, key=repr)
    assert V.row_changes(a, a, columns).count() == 0
    one = V.row_changes(
        spark.createDataFrame([("a", "1", None), ("b", "1", "2")], "k string, v string, w string"),
        spark.createDataFrame([("a", "1", "3"), ("c", "1", "2")], "k string, v string, w string"), ["k", "v", "w"],
    )
    found = V.changed_keys(one, ["k"], ["k", "v", "w"])
    assert rows(found) == [("a", "changed", 1, 1, ["w"]), ("b", "removed", 0, 1, []), ("c", "added", 1, 0, [])]


def test_sketches_of_feeds_are_merged(spark):
    r = random.Random(9)
    data = [(f, f"r{i % 3}", f"s{i % 11}", r.randint(0, 10_000)) for f in ("f", "g") for i in range(4000)]
    df = spark.createDataFrame(data, "feed_id string, route_id string, stop_id string, headway bigint")
    stored = {f: U.stop_sketches(df.where(F.col("feed_id") == f)) for f in ("f", "g")}
    both = stored["f"].unionByName(stored["g"])  # a new feed adds its own rows to the store
    for by in (["feed_id", "route_id"], ["feed_id"], []):
        steps = U.merged(U.merged(both, ["feed_id", "route_id"]), by)
        for told in U.quantiles(steps, by).collect():
            held = sorted(h for f, route, _, h in data if all({"feed_id": f, "route_id": route}[c] == told[c] for c in by))
            assert (told.n, told.least, told.most) == (len(held), held[0], held[-1])
            assert told.stops == 11
            for q in U.QUANTILES:
                value = told[f"p{round(q * 100)}"]
                below, upto = sum(h < value for h in held), sum(h <= value for h in held)
                slack = U.RANK_ERROR * len(held) + 1
                assert below <= q * len(held) + slack and upto >= q * len(held) - slack


def test_paths_in_documents_of_unlike_shape(spark):
    from headway.sources import paths as J

    texts = [
        '{"a": {"b": [1, {"c": null}, []]}, "d": "x"}', '{"a": 5}', "[[true], {}]", '"just text"', "12.5", "{", "", None,
        '{"a": {"b": [2, 3]}, "d": {}, "e.f": 1}',
    ]
    df = J.parse_documents(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "text")
    assert [r.id for r in df.where("document is null").orderBy("id").collect()] == [5, 6, 7]
    found = J.leaves(df, "id")
    want = [
        (0, "$.a.b[*]", "number", "1"), (0, "$.a.b[*].c", "null", None), (0, "$.a.b[*]", "array", None),
        (0, "$.d", "string", "x"), (1, "$.a", "number", "5"), (2, "$[*][*]", "boolean", "true"),
        (2, "$[*]", "object", None), (3, "$", "string", "just text"), (4, "$", "number", "12.5"),
        (8, "$.a.b[*]", "number", "2"), (8, "$.a.b[*]", "number", "3"), (8, "$.d", "object", None),
        (8, "$.e.f", "number", "1"),
    ]
    assert rows(found, "id", "path", "kind", "text") == sorted(want, key=repr)
    report = {(r.path, r.kind): (r.documents, r.n) for r in J.path_report(found, "id").collect()}
    assert report["$.a.b[*]", "number"] == (2, 3)
    values = J.values_at(df, {"b": ("$.a.b[1]", "int"), "a": ("$.a", "int"), "d": ("$.d", "string")})
    got = {r.id: (r.b, r.a) for r in values.collect()}
    assert got[8] == (3, None) and got[1] == (None, 5) and got[0] == (None, None) and got[5] == (None, None)
    assert J.leaves(df.where("1 = 0"), "id").count() == 0


def test_slots_grow_with_the_rows():
    from headway.operators.ranking import SLOT_ROWS, slot_digits

    assert slot_digits(0) == slot_digits(10**8) == 3
    for rows_ in (10**9, 10**11, 10**13):
        assert rows_ / 16 ** slot_digits(rows_) <= SLOT_ROWS


def test_asof_join_through_links(spark):
    r = random.Random(11)
    maybe = lambda n: r.choice([None, *range(n)])
    asks = [(i, maybe(4), [r.choice([None, r.randint(-5, 60)]) for _ in range(r.randint(0, 3))]) for i in range(40)]
    offered = [(maybe(5), r.choice([None, r.randint(-5, 60)]), maybe(9)) for _ in range(90)]
    linked = [(r.randint(0, 3), maybe(7), [r.randint(0, 4) for _ in range(r.randint(1, 2))]) for _ in range(12)]
    left = spark.createDataFrame(asks, "id int, a int, t array<bigint>")
    right = spark.createDataFrame(offered, "b int, u bigint, v int")
    links = spark.createDataFrame(linked, "a int, b int, delays array<bigint>")
    flat = left.select("id", "a", F.explode("t").alias("t")).join(links, "a").select(
        "id", "a", "b", F.explode("delays").alias("d"), "t"
    ).select("id", "a", "b", (F.col("t") + F.col("d")).alias("t"))
    for direction in ("forward", "backward"):
        for exact, within in ((True, None), (False, 9)):
            found = N.asof_join(
                left, right, ["b"], "t", "u", 10, ["v"], direction, exact, within, links=links, on=["a"]
            )
            assert found.columns == ["a", "id", "t", "b", "next_u", "next_v"]
            one = found.select("id", "a", "b", F.explode(F.arrays_zip("t", "next_u", "next_v")).alias("x")).select(
                "id", "a", "b", "x.*"
            )
            want = N.asof_join(flat, right, ["b"], "t", "u", 10, ["v"], direction, exact, within)
            assert rows(one) == rows(want) and one.count() == flat.count()


def test_linked_pairs_are_not_exchanged(spark):
    left = spark.createDataFrame([(1, "t", [5])], "a int, trip string, t array<bigint>")
    links = spark.createDataFrame([(1, 2, [1])], "a int, b int, delays array<bigint>")
    right = spark.createDataFrame([(2, 9)], "b int, u bigint")
    found = N.asof_join(left, right, ["b"], "t", "u", 10, [], links=links, on=["a"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Union" not in plan


def test_merged_intervals(spark):
    r = random.Random(5)
    data = [(r.randint(0, 3), s, s + r.randint(-2, 9)) for s in (r.randint(0, 90) for _ in range(60))]
    df = spark.createDataFrame([*data, (9, None, 4), (9, 4, None)], "k int, s int, e int")
    found = N.merged_intervals(df, ["k"], "s", "e").collect()
    covered = lambda rows: {(k, i) for k, s, e in rows for i in range(s, e)}
    assert covered([(x.k, x.s, x.e) for x in found]) == covered(data)
    ends = {(x.k, x.e) for x in found}
    assert not any((x.k, x.s) in ends for x in found) and len(found) < len(data)
