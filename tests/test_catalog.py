import json

import pytest
from conftest import rows

from headway.operators import catalog as C
from headway.sources import documents as D
from headway.sources.catalog import read_catalog

CSV = """mdb_source_id,data_type,status,provider,location.country_code,location.subdivision_name,\
location.municipality,urls.direct_download,urls.authentication_type,urls.license
1,gtfs,active,"Société de transport de Montréal (STM)",CA,Quebec,Montreal,http://a/1.zip,,
2,gtfs,,TriMet,US,Oregon,Portland,http://a/2.zip,0,http://l
3,gtfs,inactive,TriMet old,US,Oregon,,http://a/3.zip,0,
4,gtfs,deprecated,STIB-MIVB,BE,,Brussels,http://a/4.zip,0.0,
5,gtfs-rt,active,STIB live,BE,,,http://a/5.zip,,
6,gtfs,active,Locked,US,,,http://a/6.zip,1,
7,gtfs,active,No link,FR,,,,,
8,gtfs,,trimet second,US,,,http://a/8.zip,,
9,gtfs,active,,US,,,http://a/9.zip,2,
"""


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("catalog") / "catalog.csv"
    path.write_text(CSV, encoding="utf-8")
    return read_catalog(spark, str(path))


def ids(df):
    return sorted(r.mdb_source_id for r in df.collect())


def test_filters(catalog):
    assert ids(C.usable_feeds(catalog)) == [1, 2, 4, 8]
    assert ids(C.active_feeds(catalog)) == [1]
    assert ids(C.usable_feeds(catalog.drop("status", "authentication_type"))) == [
        1, 2, 3, 4, 6, 8, 9
    ]


def test_search(catalog):
    assert ids(C.provider_search(catalog, "trimet")) == [2, 3, 8]
    assert ids(C.provider_search(catalog, "SOCIÉTÉ DE", "CA")) == [1]
    assert ids(C.provider_search(catalog, "^st.b", "US")) == []


def test_regions(catalog):
    found = C.feeds_in_region(catalog)
    assert rows(found.where("country_code <> 'US'"), "mdb_source_id", "region") == [
        (1, "North America"), (4, "Europe"), (5, "Europe"), (7, "Europe")
    ]


def test_seed_feeds(spark, catalog, tmp_path):
    targets = C.target_table(spark)
    chosen = C.select_seed_feeds(C.usable_feeds(catalog), targets)
    found = chosen.collect()
    assert [r.feed_id for r in found] == ["1", "4", "2"]
    assert found[0].license_url == "nan" and found[2].status == "nan"
    assert found[1].category == "medium" and found[1].subdivision == "nan"
    assert C.unmatched_targets(C.usable_feeds(catalog), targets).count() == 12
    D.write_seed_feeds(chosen, str(tmp_path / "seed"))
    assert D.read_seed_feeds(spark, str(tmp_path / "seed")).count() == 3


def test_stats(catalog):
    (s,) = C.catalog_stats(catalog).collect()
    assert (s.total_feeds, s.countries, s.unique_providers) == (9, 4, 8)
    assert [(t.country_code, t.feeds) for t in s.top_countries] == [
        ("US", 5), ("BE", 2), ("CA", 1), ("FR", 1)
    ]


def test_feed_documents(spark, tmp_path):
    for feed, text in (("0029", {"provider": "A", "feed_id": "29"}), ("b", {"provider": "B"})):
        folder = tmp_path / f"mdb-{feed}"
        folder.mkdir()
        (folder / "metadata.json").write_text(json.dumps(text, indent=2))
    found = D.read_feed_documents(spark, str(tmp_path))
    assert rows(found, "feed_id", "provider") == [("0029", "A"), ("b", "B")]


def test_benchmark_document(spark, tmp_path):
    path = tmp_path / "benchmark.json"
    path.write_text(json.dumps({"metadata": {"n": 1}, "questions": [{"id": "BM-0001", "question": "?"}]}))
    assert rows(D.read_benchmark(spark, str(path)), "id", "question") == [("BM-0001", "?")]
