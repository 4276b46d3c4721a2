from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.functions import scalars as A
from headway.functions import texts as X


def values(spark, column, *data, kind="string"):
    """The column's value for every given value of ``c``."""
    schema = f"i int, c {kind}"
    df = spark.createDataFrame(list(enumerate(data)), schema)
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_route_and_transfer_types(spark):
    c = F.col("c")
    assert values(spark, A.route_type_name(c), 3, 11, 99, None, kind="int") == [
        "Bus", "Trolleybus", "Unknown (type 99)", None
    ]
    assert values(spark, A.route_type_name(c, A.ROUTE_TYPES_SHORT), 0, 2, kind="int") == [
        "Tram/Light Rail", "Rail"
    ]
    assert values(spark, A.transfer_type_name(c), 0, 3, 4, None, kind="int") == [
        "Recommended transfer point", "No transfer possible", "a standard transfer", "a transfer"
    ]


@pytest.mark.parametrize("next_day", [A.NEXT_DAY, A.NEXT_DAY_SHORT])
def test_times_of_day(spark, next_day):
    times = ["04:30:00", "9:00:00", "00:05:00", "12:00:00", "23:59:00", "24:00:00", "25:15:00",
             "36:10:00", "", None, "bad", "10:20", "xx:10:00"]
    assert values(spark, A.format_gtfs_time(F.col("c"), next_day), *times) == [
        "4:30 AM", "9:00 AM", "12:05 AM", "12:00 PM", "11:59 PM", f"12:00 AM{next_day}",
        f"1:15 AM{next_day}", f"12:10 PM{next_day}", "unknown", "unknown", "bad", "10:20",
        "xx:10:00",
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 47), st.integers(0, 59), st.integers(0, 59)), min_size=1))
def test_seconds_of_all_hours(spark, times):
    padded = [f"{h:02d}:{m:02d}:{s:02d}" for h, m, s in times]
    bare = [f"{h}:{m:02d}:{s:02d}" for h, m, s in times]
    expected = [h * 3600 + m * 60 + s for h, m, s in times]
    assert values(spark, A.gtfs_seconds(F.col("c")), *padded) == expected
    assert values(spark, A.gtfs_seconds(F.col("c")), *bare) == expected


def test_bad_times_have_no_seconds(spark):
    assert values(spark, A.gtfs_seconds(F.col("c")), "bad", "", None, "1:2") == [None] * 4
    assert values(spark, A.gtfs_minutes(F.col("c")), "5:30", "x:30") == [330, None]


def test_headway(spark):
    df = spark.createDataFrame(
        [("06:00:00", "08:00:00", 12), ("06:00:00", "08:00:00", 1), ("08:00:00", "06:00:00", 5),
         ("bad", "08:00:00", 5)],
        "a string, b string, n int",
    )
    found = df.select(A.avg_headway(F.col("a"), F.col("b"), F.col("n")).alias("h")).collect()
    assert [r.h for r in found] == [10.0, None, None, None]


def test_numbers_as_text(spark):
    c = F.col("c")
    assert values(spark, A.thousands(c), 1234567, 12, kind="bigint") == ["1,234,567", "12"]
    assert values(spark, A.fixed(c, 4), 48.1, -2.0, kind="double") == ["48.1000", "-2.0000"]
    assert values(spark, A.fixed(c, 0), 284.5, 285.5, 9.6, kind="double") == ["284", "286", "10"]


def test_modes(spark):
    df = spark.createDataFrame([({11: 1, 3: 125, 99: 2},), ({},), (None,)], "m map<int,bigint>")
    assert [r[0] for r in df.select(A.modes_text(F.col("m"))).collect()] == [
        "125 Bus routes, 1 Trolleybus route, 2 Unknown (type 99) routes", "no routes", "no routes"
    ]


def test_names(spark):
    df = spark.createDataFrame(
        [("1", "Harbour"), ("", "Hill"), ("M", None), (None, "")], "s string, l string"
    )
    s, l = F.col("s"), F.col("l")
    found = df.select(A.display_name(s, l), A.full_name(s, l)).collect()
    assert [tuple(r) for r in found] == [
        ("1", "1 (Harbour)"), ("Hill", "Hill"), ("M", "M"), (None, None)
    ]


def test_numbers_in_texts(spark):
    c = F.col("c")
    assert values(spark, X.numbers_in(c), "1,234 stops, 84.0 and 84.0; v2 3a 7.", "none") == [
        ["1234", "84.0", "7"], []
    ]
    df = spark.createDataFrame(
        [("12 and 13", "13 only"), ("none", "1"), ("5", None), ("5 6", "5 6 7")],
        "e string, g string",
    )
    found = df.select(X.keyword_match(F.col("e"), F.col("g"))).collect()
    assert [r[0] for r in found] == [0.5, 1.0, 0.0, 1.0]


def test_criteria(spark):
    c = F.col("c")
    assert values(
        spark, X.criteria_terms(c),
        "Must mention: a b, c d and e f", "must STATE 133 routes",
        "Must mention at least 2 of: times, (walking), x or delays", "", "Must explain",
        "Sand and oranges",
    ) == [
        ["a b", "c d", "e f"], ["133 routes"], ["times", "walking", "delays"], [],
        [], ["Sand", "oranges"],
    ]
    assert values(spark, X.criteria_minimum(c), "Must list at least 4 of x", "Must list 4") == [
        4, None
    ]
    rule = "Must mention at least 2 of: red, green, blue"
    df = spark.createDataFrame(
        [(rule, "Red and BLUE"), (rule, "only red"), ("Must mention: red, blue", "red"),
         ("", "red"), ("Must mention: red", ""), ("Must mention: red", None)],
        "c string, g string",
    )
    found = df.select(X.criteria_match(c, F.col("g"))).collect()
    assert [r[0] for r in found] == [1.0, 0.5, 0.5, 0.0, 0.0, 0.0]


def common_by_table(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = (
            table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        )
    return table[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=70), st.lists(st.sampled_from("abcde"), max_size=70))
def test_common_subsequence_by_brute_force(a, b):
    assert X._common_length(a, b) == common_by_table(a, b)


def test_rouge(spark):
    df = spark.createDataFrame(
        [(1, "The cat sat, on the mat.", "the CAT on a mat"), (2, "a b", ""), (3, "", ""),
         (4, "same", "same"), (5, None, "x")],
        "i int, e string, g string",
    )
    score = X.rouge_l(X.tokens(F.col("e")), X.tokens(F.col("g")))
    found = [r.s for r in df.orderBy("i").select(score.alias("s")).collect()]
    # the cat on mat: 4 of 5 given and 4 of 6 expected tokens
    assert found[0] == pytest.approx(2 * (4 / 5) * (4 / 6) / (4 / 5 + 4 / 6))
    assert found[1:] == [0.0, 0.0, 1.0, 0.0]


def test_long_texts_are_compared_whole():
    a = [str(i % 997) for i in range(20_000)]
    b = ["x"] * 10_000 + a[5:]
    assert X._common_length(a, b) == len(a) - 5


def test_other_texts(spark):
    c = F.col("c")
    assert values(spark, X.token_count(c), " two  words\n", "", None) == [2, 0, 0]
    assert values(spark, X.verdict(c, "old", "new"), 0.06, 0.05, 0.0, -0.05, kind="double") == [
        "new significantly outperforms the old.", "new slightly outperforms the old.",
        "Performance is roughly equivalent.", "The old outperforms new.",
    ]
    assert values(spark, X.claimed_count(c, "routes"), "1,234 routes, 5 routes", "many routes") == [
        1234, None
    ]
    assert values(
        spark, X.claimed_count(c, "routes", before="operates"), "3 routes; operates 7 routes"
    ) == [7]
    assert values(spark, X.render_chat(F.lit("S"), c, F.lit("A")), "Q") == [
        "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nQ<|im_end|>\n"
        "<|im_start|>assistant\nA<|im_end|>\n"
    ]
    assert values(spark, A.clip(c, 2), "äöü") == ["äö"]


def test_weights(spark):
    parts = F.lit(1.0), F.lit(0.5), F.lit(0.0)
    assert values(spark, X.combined_score(*parts), "x") == [pytest.approx(0.55)]
    assert values(spark, X.combined_score(*parts, weights=(0, 1, 0)), "x") == [0.5]
    # published: 0.4091, 0.3981 and 0.0984 give 0.3126
    scores = F.lit(0.4091), F.lit(0.3981), F.lit(0.0984)
    assert values(spark, F.round(X.combined_score(*scores), 4), "x") == [0.3126]
