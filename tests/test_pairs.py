import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.functions.scalars import fill
from headway.operators import pairs as P
from headway.plans import benchmark_items as B
from headway.plans import question_pairs as Q
from headway.plans import templates as T
from headway.plans.validate_pairs import load_numbered, validate_pairs
from headway.schema import PAIR_FIELDS
from headway.sources import documents as D


def pair(instruction, response, category="network_stats", template="t", feed="0029"):
    return dict(zip(PAIR_FIELDS, (instruction, response, category, template, feed, "Alpha")))


LINES = [
    json.dumps(pair("How big is Alpha?", "It has 3 routes and 6 stops in the city.")),
    "",
    json.dumps(pair("How big is Alpha?", "It has 1,234 routes and 6 stops, or so.")),
    json.dumps({k: v for k, v in pair("Übung?", "Eine Antwort von genug Länge.").items()
                if k != "provider"}),
    json.dumps({**pair("null field", "An answer that is long enough."), "category": None}),
    "{not json",
    "   ",
    json.dumps(pair("", "   ", "schedule")),
    json.dumps(pair("How big is Alpha?", "short", "schedule", "agency_route_count_v1")),
    json.dumps(pair("Size?", "Alpha operates 3 routes for you.", "x", "agency_route_count_v1")),
    json.dumps(pair("Other feed?", "It has 99 routes and 6 stops here.", feed="nowhere")),
]


@pytest.fixture(scope="module")
def numbered(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pairs") / "pairs.jsonl"
    path.write_text("\n".join(LINES), encoding="utf-8")
    return load_numbered(spark, str(path)), str(path)


def test_read_pairs(spark, numbered):
    pairs, path = numbered
    assert [r.record for r in pairs.orderBy("record").collect()] == list(range(8))
    assert rows(D.invalid_lines(spark, path).select("_corrupt")) == [("{not json",)]
    assert "Übung?" in {r.instruction for r in pairs.collect()}


def test_format(numbered):
    (check,) = P.check_format(numbered[0], "record").collect()
    assert not check.passed and check.total_records == 8
    assert check.issues == ["Record 2: missing fields provider"]


def test_content(numbered):
    (check,) = P.check_content(numbered[0], "record").collect()
    assert check.issues == [
        "Record 4: empty instruction", "Record 4: empty response",
        "Record 5: response too short (5 chars)",
    ]
    assert (check.instruction_min, check.instruction_max, check.response_min) == (0, 17, 3)


def test_duplicates(numbered):
    (check,) = P.check_duplicates(numbered[0], ["record"]).collect()
    assert check.duplicate_count == 2 and check.samples == ["How big is Alpha?"] * 2


def test_duplicate_samples_of_one_hot_text(spark):
    df = spark.range(500).selectExpr("id as record", "if(id % 3 = 0, repeat('ab', 80), 'x' || id) as instruction")
    found = P.duplicate_samples(df, ["record"]).collect()
    assert [r.record for r in found] == list(range(3, 33, 3)) and len(found[0].sample) == 100


def test_facts(numbered, summary):
    (check,) = P.check_facts(numbered[0], summary.feed_stats).collect()
    # routes and stops of two texts, the agency's routes; the text without numbers gives none
    assert (check.checks_performed, check.checks_passed, check.accuracy) == (5, 4, 80.0)
    assert check.mismatches == ["Feed 0029: route count 1234 != expected 3"]


def test_validation(spark, numbered, summary, tmp_path):
    done = validate_pairs(numbered[0], summary.feed_stats, line="value")
    (report,) = done.report.collect()
    assert not report.all_checks_passed and report.total_pairs == 8
    assert report.train_size + report.test_size == 8
    checks = {json.loads(c)["check"]: json.loads(c) for c in report.checks}
    assert list(checks) == ["format", "content_quality", "duplicates", "distribution",
                            "factual_accuracy"]
    assert checks["distribution"]["categories"] == {
        "network_stats": 4, "schedule": 2, "unknown": 1, "x": 1
    }
    done.write(str(tmp_path))
    read = D.read_splits(spark, f"{tmp_path}/pairs")
    assert rows(read.groupBy("split").count()) == [
        ("test", report.test_size), ("train", report.train_size)
    ]


def test_valid_dataset_passes(spark, summary):
    data = [pair(f"q{i}", "An answer that is long enough.") for i in range(10)]
    df = spark.createDataFrame([(i, *d.values()) for i, d in enumerate(data)],
                               ["record", *PAIR_FIELDS])
    done = validate_pairs(df, summary.feed_stats)
    (report,) = done.report.collect()
    assert report.all_checks_passed and (report.train_size, report.test_size) == (9, 1)


def texts(df):
    return {(r.template_id, r.instruction): r.response for r in df.collect()}


def test_route_texts(summary):
    found = texts(Q.route_pairs(summary).where("feed_id = '0029'"))
    assert found["route_describe_v1", "Describe route 1 operated by Alpha."] == (
        "Route 1 (Harbour) is a Bus service operated by Alpha. It runs approximately 3 trips."
        " The route serves 3 stops. Destinations include: Centre, Harbour."
    )
    assert found["route_describe_v2", "What type of service is route M by Alpha?"] == (
        "Route M by Alpha is a Subway/Metro service."
    )
    assert found["route_schedule_v2", "Give me a schedule overview of route 1 by Alpha."] == (
        "Route 1 by Alpha runs 3 trips serving 3 stops. Service starts at 5:30 AM and ends at"
        " 1:15 AM (next day)."
    )


def test_feed_texts(summary):
    found = texts(Q.data_pairs(summary))
    assert found["agency_modes_v1", "What transit modes does Alpha Lines operate?"] == (
        "Alpha Lines operates the following transit services: 1 Subway/Metro route, 1 Bus route,"
        " 1 Trolleybus route. In total, the agency has 3 routes."
    )
    assert found["agency_route_count_v1", "How many routes does Beta have?"] == (
        "Beta operates 1 routes. 1 are Bus routes."
    )
    assert found["route_list_by_type", "List all trolleybus routes operated by Alpha."] == (
        "Alpha operates 1 trolleybus routes: Hill Line."
    )
    assert found["stop_count", "How many stops are in the Alpha network?"] == (
        "The Alpha network has 6 stops. Of these, 1 are classified as stations (parent stops)."
    )
    assert found["stop_location_v1", "Where is the Quay, North stop located in the Alpha network?"] == (
        "The Quay, North stop is located at latitude 48.3000, longitude 2.3000 in the Alpha"
        " transit network."
    )
    assert found["transfer_info", "What is the transfer between Platform 1 and Market in the Alpha system?"] == (
        "There is Minimum time required between Platform 1 and Market in the Alpha network. The"
        " minimum transfer time is 180 seconds (3 minutes)."
    )
    assert not any("Hill Foot and " in i for (t, i) in found if t == "transfer_info")
    assert found["network_overview_v1", "Give me an overview of the Alpha transit network."] == (
        "The Alpha transit network consists of 3 routes serving 6 stops. There are approximately"
        " 5 scheduled trips. On average, each route serves about 2.0 stops and runs 2 trips."
    )
    # a feed without a provider has no network texts
    assert not any(r.feed_id == "dates" for r in Q.network_pairs(summary).collect())


def test_journey_texts(summary):
    found = texts(Q.journey_pairs(summary).where("feed_id = '0029'"))
    assert found["earliest_service", "What is the earliest service available on Alpha?"].startswith(
        "Route 1 has one of the earliest departures at 05:30:00"
    )
    assert found["late_night_service", "Does Alpha offer late-night service?"] == (
        "Yes, route 1 runs until 25:15:00, providing late-night service."
    )
    assert found["most_frequent_route", "What is the most frequent route on Alpha?"].startswith(
        "Route 1 is the most frequent with 3 scheduled trips"
    )
    assert found["multimodal_journey", "Can I combine different transit modes on Alpha?"].startswith(
        "Yes, Alpha operates multiple transit modes: Subway/Metro, Bus, Trolleybus."
    )
    beta = texts(Q.journey_pairs(summary).where("feed_id = 'b'"))
    # 9:00:00 is late as text; one route has no most frequent one
    assert {t for t, _ in beta} == {"late_night_service"}


def test_comparisons(summary):
    found = texts(Q.comparative_pairs(summary))
    assert found["most_routes", "Which transit agency in the dataset has the most routes?"] == (
        "Alpha (FR) has the most routes with 3 routes. The top 5 by route count are: Alpha (3),"
        "  (3), Beta (1)."
    )
    assert found["compare_pair", "Compare the transit networks of Alpha and Beta."] == (
        "Alpha (FR) has 3 routes and 6 stops. Beta (BE) has 1 routes and 2 stops. The former has"
        " more routes, while the former has more stops."
    )
    assert found["countries", "What countries are represented in the transit dataset?"] == (
        "The dataset covers transit agencies from 2 countries: BE: Beta. FR: Alpha, ."
    )
    sizes = texts(Q.size_pairs(summary))
    assert sizes["most_trips", "Which transit agency has the most scheduled trips?"] == (
        "Alpha (FR) has the most scheduled trips with 5. The fewest is Beta with 1 trips."
    )


def test_user_templates(summary):
    mine = T.Template("extra", "stop_names", "stop", "stop_name <> ''", "Name of {stop_id}?",
                      ["It is {stop_name}."])
    T.register_template(mine)
    try:
        found = texts(Q.generate_dataset(summary, stored=False))
    finally:
        T.REGISTRY.clear()
    assert found["stop_names", "Name of S2?"] == "It is Market."


def test_generated_dataset(summary, spark, tmp_path):
    fixed = spark.createDataFrame([("What is GTFS?", "A format.", "gtfs_knowledge", "what")],
                                  "instruction string, response string, category string, template_id string")
    made = Q.generate_dataset(summary, fixed, expanded=True, stored=False)
    found = made.collect()
    assert len({r.instruction for r in found}) == len(found) > 60
    (known,) = [r for r in found if r.template_id == "what"]
    assert (known.feed_id, known.provider) == ("", "")
    D.write_pairs(made, str(tmp_path / "out"))
    assert D.read_pairs(spark, str(tmp_path / "out")).count() == len(found)


def test_benchmark(summary, spark, tmp_path):
    static = spark.createDataFrame(
        [("What is headway?", "Time.", "Must define", "easy", "transit_operations")],
        "question string, expected_answer string, scoring_criteria string, difficulty string,"
        " category string",
    )
    items = B.build_benchmark(summary, B.static_items(static, 5), stored=False)
    found = items.orderBy("id").collect()
    assert [r.id for r in found] == [f"BM-{i:04d}" for i in range(1, len(found) + 1)]
    assert found[0].question == "How many transit routes does Alpha operate?"
    by_question = {r.question: r for r in found}
    assert by_question["Which route in the Alpha network serves the most stops?"].expected_answer == (
        "Route 1 serves the most stops with 3 stops."
    )
    hours = by_question["What are the operating hours for route M by Alpha?"] if (
        "What are the operating hours for route M by Alpha?" in by_question
    ) else by_question["What are the operating hours for route 1 by Alpha?"]
    assert hours.category == "schedule_reasoning"
    stages = [r.category for r in found]
    assert stages.index("transit_operations") > stages.index("schedule_reasoning")
    D.write_benchmark(items, P.benchmark_metadata(items), str(tmp_path), "bench")
    (meta,) = spark.read.json(f"{tmp_path}/metadata").collect()
    assert meta.total_questions == len(found) and meta.categories.transit_operations == 3


def test_prompt(summary):
    context = B.feed_context(summary)
    (found,) = B.feed_prompt(context, "How many stops?").where("feed_id = '0029'").collect()
    lines = found.context.split("\n")
    assert lines[:3] == [
        "Agency: Alpha Lines (timezone: Europe/Paris)", "Total routes: 3",
        "Route types: 1 Subway/Metro, 1 Bus, 1 Trolleybus",
    ]
    assert "  Route 1: Bus, 3 trips, 3 stops, 05:30:00-25:15:00" in lines
    assert lines[-1] == "Network: 5 total trips, avg 2.0 stops/route, avg 1.7 trips/route"
    assert found.prompt.endswith("answer the following question:\nHow many stops?")


def test_fill(spark):
    df = spark.createDataFrame([(1234, None, "AB")], "n int, x string, s string")
    (r,) = df.select(fill("{n:,}|{x}|{s:lower}|{{}}|{y}", y=F.lit(2)).alias("t")).collect()
    assert r.t == "1,234||ab|{}|2"


def test_blank_texts_of_any_kind(spark):
    df = spark.createDataFrame([(1, "\n\t", " \r\n")], "record int, instruction string, response string")
    assert [r.issue for r in P.content_issues(df, "record").collect()] == [
        "Record 1: empty instruction", "Record 1: empty response"
    ]
