from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.functions.scalars import safe_int, whole_number
from headway.operators import cleaning as K
from headway.operators import integrity as I
from headway.schema import TABLES
from headway.sources import lake


def test_numbers_from_text(spark):
    texts = ["1.0", "1", " 2 ", "1.5", "300", "x", "", None, "-2", "1e2", "1d", "0x1", "NaN", "inf"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = df.orderBy("i").select(
        whole_number(F.col("t"), "tinyint").alias("v"), safe_int(F.col("t")).alias("s")
    ).collect()
    assert [r.v for r in found] == [
        1, 1, 2, None, None, None, None, None, -2, 100, None, None, None, None
    ]
    assert [r.s for r in found][:9] == [1, 1, 2, 1, 300, None, None, None, -2]


def test_dirty_feed(spark, cleaned):
    result, _, out = cleaned
    stops = lake.read_clean(spark, out, "stops").where("feed_id = 'dirty'")
    assert rows(stops, "stop_id", "stop_name", "stop_lat", "stop_lon", "location_type") == sorted(
        [
            ("S1", "first", 48.1, None, 1),
            ("S2", "two", None, None, None),
            (None, "nameless", 48.0, None, None),
            ("S3", "three", 100.0, None, None),
        ],
        key=repr,
    )
    (stats,) = result.stats.where("feed_id = 'dirty' and table = 'stops'").collect()
    assert (stats.rows_raw, stats.rows_cleaned, stats.duplicates_removed) == (6, 4, 2)
    # x as latitude; 1.5, 300 and x as location type
    assert stats.n_coerced_null == 4
    assert stats.columns_kept == ["stop_id", "stop_name", "stop_lat", "location_type", "stop_lon"]
    assert stats.columns_dropped == []


def test_dropped_columns_and_feed_ids(cleaned, spark):
    result, _, out = cleaned
    (stats,) = result.stats.where("feed_id = 'b' and table = 'agency'").collect()
    assert stats.columns_dropped == ["motto"]
    assert ("0029",) in rows(lake.read_clean(spark, out, "routes", []).distinct())


def test_integrity(cleaned):
    result, _, _ = cleaned
    found = {(r.feed_id, r.rule): r.orphans for r in result.integrity.collect()}
    assert [found["orphans", r] for r in I.RULES] == [1, 1, 1, 1]
    assert [found["0029", r] for r in I.RULES] == [0, 0, 0, 0]
    # the service rule is not checked where no service is known
    assert ("nocal", I.RULES[3]) not in found and ("nocal", I.RULES[0]) in found


def test_feed_messages_and_report(cleaned):
    result, _, _ = cleaned
    feeds = {r.feed_id: r for r in result.feeds.collect()}
    assert feeds["0029"].success and feeds["0029"].warnings == []
    assert feeds["short"].errors == [
        "Missing required file: agency.txt", "Missing required file: trips.txt"
    ]
    assert feeds["empty"].warnings == [
        "orphan_route_ids_in_trips: 3", "routes.txt is empty"
    ] or feeds["empty"].warnings == ["routes.txt is empty"]
    assert feeds["headers"].warnings == ["transfers.txt is empty"]
    assert feeds["broken"].errors[0].startswith("Unexpected error: Not a valid ZIP")
    assert "orphan_stop_ids_in_stop_times: 1" in feeds["orphans"].warnings
    (report,) = result.report.collect()
    assert (report.total_feeds, report.successful, report.failed) == (10, 8, 2)
    assert report.total_routes == 3 * 7 + 1


def test_reports_are_written(spark, cleaned, tmp_path):
    cleaned[0].write(str(tmp_path))
    (report,) = spark.read.json(f"{tmp_path}/_report").collect()
    assert report.total_feeds == 10 and "T" in report.generated_at


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2)), min_size=1))
def test_keep_first_properties(spark, keys):
    df = spark.createDataFrame(
        [("f", k, n, i) for i, (k, n) in enumerate(keys)], "feed_id string, k string, n int, i int"
    )
    once = K.keep_first(df, ["feed_id", "k", "n"], ["i"])
    firsts = {}
    for i, key in enumerate(keys):
        firsts.setdefault(key, i)
    assert sorted(r.i for r in once.collect()) == sorted(firsts.values())
    again = K.keep_first(once, ["feed_id", "k", "n"], ["i"])
    assert rows(again) == rows(once)


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.sampled_from(["a", "b", "c", None])), st.lists(st.sampled_from(["a", "b", None]))
)
def test_orphans_are_a_set_difference(spark, child, parent):
    schema = "feed_id string, k string"
    c = spark.createDataFrame([("f", k) for k in child], schema)
    p = spark.createDataFrame([("f", k) for k in parent], schema)
    expected = {k for k in child if k is not None} - set(parent)
    assert {r.k for r in I.orphans(c, p, "k").collect()} == expected


def test_cleaning_limits_copies_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("string(id % 2) as feed_id", "id % 3 as k", "id as i")
    plan = K.keep_first(df, ["feed_id", "k"], ["i"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_canonical_columns_of_every_table(spark):
    for spec in TABLES.values():
        df = spark.createDataFrame([("f", "x")], f"feed_id string, {spec.columns[-1]} string")
        typed = K.coerce_types(K.canonical_columns(df, spec), spec)
        assert typed.schema.simpleString() == spec.struct.simpleString()
