import hashlib

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators import ranking as R


def table(spark, sizes, parts=3):
    data = [(c, f"{c}{i}", i) for c, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(data, "category string, k string, _pos int")
    return df.withColumn("feed_id", F.col("category")).repartition(parts)


def digest(key, seed=42):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


def test_split_sizes(spark):
    df = table(spark, {"a": 1, "b": 2, "c": 9, "d": 10, "e": 11})
    split = R.stratified_split(df, key=["k"])
    found = split.groupBy("category").pivot("split", ["train", "test"]).count().fillna(0)
    assert rows(found, "category", "train", "test") == [
        ("a", 0, 1), ("b", 1, 1), ("c", 8, 1), ("d", 9, 1), ("e", 9, 2)
    ]
    assert rows(split, "k") == rows(df, "k")


def test_split_takes_all_but_one(spark):
    split = R.stratified_split(table(spark, {"a": 3, "b": 1}), ratio=1.0, key=["k"])
    assert rows(split.groupBy("category", "split").count()) == [
        ("a", "test", 1), ("a", "train", 2), ("b", "train", 1)
    ]


def test_split_is_by_hash_order(spark):
    split = R.stratified_split(table(spark, {"a": 50}), ratio=0.5, key=["k"])
    order = sorted((f"a{i}" for i in range(50)), key=digest)
    assert {r.k for r in split.where("split = 'train'").collect()} == set(order[:25])


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.sampled_from("abc"), st.integers(1, 30), min_size=1),
       st.sampled_from([0.1, 0.5, 0.9]))
def test_split_of_copies_keeps_all_rows(spark, copies, ratio):
    data = [("x", k) for k, n in copies.items() for _ in range(n)]
    df = spark.createDataFrame(data, "category string, k string")
    split = R.stratified_split(df, ratio)
    assert rows(split, "category", "k") == sorted(data, key=repr)
    n = len(data)
    train = int(n * ratio)
    train -= train == n and n >= 2
    assert split.where("split = 'train'").count() == train


def test_repeat_rows_in_chunks(spark):
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 10)], "k string, n bigint")
    found = R.repeat_rows(df, "n", chunk=10).groupBy("k").count()
    assert rows(found) == [("a", 25), ("b", 1), ("c", 10)]


def test_unknown_category(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), ("unknown", "c")], "category string, k string")
    split = R.stratified_split(df, 0.67, key=["k"])
    assert split.where("split = 'train'").count() == 2


@pytest.mark.parametrize("parts", [1, 7])
def test_sample_does_not_depend_on_partitions(spark, parts):
    df = table(spark, {"a": 40, "b": 3}, parts)
    found = R.sample_n_per_feed(df, 5, ["k"], 42)
    expected = sorted((f"a{i}" for i in range(40)), key=digest)[:5] + ["b0", "b1", "b2"]
    assert {r.k for r in found.collect()} == set(expected)
    other = R.sample_n_per_feed(df, 5, ["k"], 43)
    assert rows(other, "k") != rows(found, "k")


def test_limits_are_applied_before_the_shuffle(spark):
    df = table(spark, {"a": 40})
    for limited in (
        R.first_n_per_feed(df, 5),
        R.sample_n_per_feed(df, 5, ["k"], 42),
        R.first_n(df, 1, ["feed_id"], [F.desc("_pos")]),
    ):
        assert "WindowGroupLimit" in limited._jdf.queryExecution().toString()


def routes(spark, counts):
    data = [("f", f"r{i}", n, i) for i, n in enumerate(counts)]
    return spark.createDataFrame(data, "feed_id string, route_id string, trip_count int, _pos int")


def test_pick_routes(spark):
    found = R.pick_routes(routes(spark, [0] * 5 + list(range(1, 41)))).collect()
    assert sorted(r.pick for r in found) == list(range(1, 16))
    busiest = [r.trip_count for r in sorted(found, key=lambda r: r.pick)][:7]
    assert busiest == [40, 39, 38, 37, 36, 35, 34]
    assert len({r.route_id for r in found}) == 15
    few = R.pick_routes(routes(spark, [0, 3, 3, 9])).orderBy("pick").collect()
    assert [(r.route_id, r.pick) for r in few] == [("r3", 1), ("r1", 2), ("r2", 3)]


def test_best_route(spark):
    best = R.best_route(routes(spark, [4, 9, 9]), "trip_count")
    assert rows(best, "route_id") == [("r1",)]
    assert R.best_route(routes(spark, [4]), "trip_count").count() == 0


def test_top_and_last(spark):
    df = spark.createDataFrame([("a", 3), ("b", 9), ("c", 3), ("d", 9)], "feed_id string, n int")
    top = R.top_feeds(df, "n", 3)
    assert rows(top, "feed_id", "rank") == [("a", 3), ("b", 1), ("d", 2)]
    assert rows(R.last_feed(df, "n"), "feed_id") == [("c",)]


def test_ranks_by_slots(spark):
    df = table(spark, {"a": 300, "b": 1})
    found = R.slot_ranks(df, ["k"], 5, ["category"])
    order = sorted((f"a{i}" for i in range(300)), key=lambda k: digest(k, 5))
    ranks = {r.k: r.rank for r in found.collect()}
    assert [ranks[k] for k in order] == list(range(1, 301)) and ranks["b0"] == 1


def test_random_pairs(spark):
    feeds = spark.createDataFrame([(f"f{i}",) for i in range(7)], "feed_id string")
    found = R.shuffled_pairs(feeds).collect()
    used = [x for r in found for x in (r.a_feed_id, r.b_feed_id)]
    assert len(found) == 3 and len(set(used)) == 6


def test_neighbours(spark):
    feeds = spark.createDataFrame([(f"f{i:02d}",) for i in range(15)], "feed_id string")
    found = R.neighbour_pairs(feeds)
    assert rows(found, "a_feed_id", "b_feed_id") == [
        (f"f{i:02d}", f"f{i + 1:02d}") for i in range(10)
    ]


def test_numbers_over_many_partitions(spark):
    df = spark.range(1000).selectExpr("(id * 37) % 1000 as n").repartition(13)
    found = R.number_rows(df, ["n"], "place")
    assert found.where("place <> n + 1").count() == 0 and found.count() == 1000
    ids = R.assign_ids(df.limit(3), ["n"])
    assert [r.id for r in ids.orderBy("n").collect()] == ["BM-0001", "BM-0002", "BM-0003"]


def test_limit(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "id string")
    assert rows(R.limit_rows(df, 2)) == [("a",), ("b",)]
    assert R.limit_rows(df, 0).count() == 3


def test_pick_one_of_the_first(spark):
    df = table(spark, {"a": 40, "b": 1})
    found = {r.feed_id: r.k for r in R.pick_one(df, 20, ["k"], 42).collect()}
    assert found == {"a": min((f"a{i}" for i in range(20)), key=digest), "b": "b0"}


def test_shuffle_is_repeatable(spark):
    df = table(spark, {"a": 30})
    order = [r.k for r in R.shuffle_rows(df, ["k"]).collect()]
    assert order == sorted(order, key=digest)


def test_best_and_worst_ties(spark):
    df = spark.createDataFrame(
        [("1", "x", 0.5), ("2", "x", 0.5), ("3", "x", 0.1), ("4", "x", 0.1), ("5", "y", 0.3)],
        "id string, category string, combined double",
    )
    found = R.best_and_worst(df)
    assert rows(found, "category", "which", "id") == [
        ("x", "best", "1"), ("x", "worst", "4"), ("y", "best", "5"), ("y", "worst", "5")
    ]
