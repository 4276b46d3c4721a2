"""Whole jobs, as a user starts them."""

import json

from conftest import rows

from headway.__main__ import main
from headway.plans.explore import explore_feed


def test_explore(spark, archive_folder, tmp_path):
    look = explore_feed(spark, str(archive_folder), "0029", f"{tmp_path}/raw", f"{tmp_path}/out")
    assert look.validation.first().is_valid
    (found,) = look.prompt("How many routes?").collect()
    assert "Total routes: 3" in found.prompt and found.prompt.endswith("How many routes?")
    names = {r.to_stop_name for r in look.summary.sample_transfers.collect()}
    assert names == {"Market", "Hill Foot", "S9"}
    bad = explore_feed(spark, str(archive_folder), "short", f"{tmp_path}/raw", f"{tmp_path}/out")
    assert bad.summary is None and not bad.validation.first().is_valid


def test_sql_views(spark, summary):
    summary.register()
    found = spark.sql("""
        select r.route_id, count(*) as n from routes r join trips t using (feed_id, route_id)
        where feed_id = '0029' group by 1""")
    assert rows(found) == [("R1", 3), ("R2", 1), ("R3", 1)]
    assert spark.sql("select sum(trip_count) from route_stats where feed_id = '0029'").first()[0] == 5


def test_from_store_to_scores(spark, cleaned, archive_folder, tmp_path):
    """Statistics, pairs, their validation, a benchmark and its scores."""
    (archive_folder / "mdb-0029" / "metadata.json").write_text(
        json.dumps({"provider": "Alpha", "country_code": "FR"})
    )
    t, store = str(tmp_path), cleaned[2]
    named = ["--metadata", str(archive_folder)]
    main(["summarise", store, f"{t}/stats", *named])
    (feed,) = spark.read.json(f"{t}/stats/feeds").collect()
    assert (feed.provider, feed.network_stats.total_trips) == ("Alpha", 5)
    main(["generate", store, f"{t}/pairs", "--expanded", *named])
    main(["check-pairs", f"{t}/pairs", f"{t}/stats", f"{t}/checked"])
    (report,) = spark.read.json(f"{t}/checked/report").collect()
    assert report.all_checks_passed and report.total_pairs > 30
    main(["benchmark", store, f"{t}/bench", *named])
    items = spark.read.json(f"{t}/bench/questions")
    items.selectExpr("id", "expected_answer as generated").write.json(f"{t}/answers")
    main(["score", f"{t}/answers", f"{t}/bench/questions", f"{t}/run"])
    (overall,) = spark.read.json(f"{t}/run/report").where("level = 'overall'").collect()
    assert overall.rouge_l_avg == 1.0 and overall["count"] == items.count()
    main(["compare", f"{t}/run/report", f"{t}/run/report"])
