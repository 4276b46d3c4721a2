from __future__ import annotations

import sys
import zipfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from bench import session

    spark = session("8")
    yield spark
    spark.stop()


CALENDAR_HEADER = (
    "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date"
)

FEED_A = {
    "agency.txt": """agency_id,agency_name,agency_url,agency_timezone
A1,Alpha Lines,http://alpha.example,Europe/Paris
""",
    "routes.txt": """route_id,route_short_name,route_long_name,route_type,agency_id
R1,1,Harbour,3,A1
R2,M,,1,A1
R3,,Hill Line,11,A1
""",
    "trips.txt": """route_id,service_id,trip_id,trip_headsign,direction_id
R1,WD,T1,Harbour,0
R1,WD,T2,Centre,1
R1,WE,T3,Harbour,0
R2,WD,T4,,0
R3,WE,T5,Hill,0
""",
    "stops.txt": """stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station
S0,Central,48.1,2.1,1,
S1,Platform 1,48.11,2.11,0,S0
S2,Market,48.2,2.2,0,
S3,"Quay, North",48.3,2.3,0,
S4,Hill Foot,48.4,2.4,,
S5,Hill Top,48.5,2.5,,
""",
    "stop_times.txt": """trip_id,arrival_time,departure_time,stop_id,stop_sequence
T1,05:30:00,05:30:00,S1,1
T1,05:40:00,05:40:00,S2,2
T1,05:50:00,05:50:00,S3,3
T2,12:00:00,12:00:00,S3,1
T2,12:10:00,12:10:00,S2,2
T2,12:20:00,12:20:00,S1,3
T3,25:15:00,25:15:00,S1,1
T3,25:25:00,25:25:00,S2,2
T3,25:35:00,25:35:00,S3,3
T4,06:00:00,06:00:00,S1,1
T4,06:05:00,06:05:00,S2,2
T5,09:00:00,09:00:00,S4,10
T5,09:10:00,09:10:00,S5,20
T5,09:20:00,09:20:00,S4,30
""",
    "calendar.txt": f"""{CALENDAR_HEADER}
WD,1,1,1,1,1,0,0,20260101,20261231
WE,0,0,0,0,0,1,1,20260201,20261130
""",
    "calendar_dates.txt": """service_id,date,exception_type
WD,20260501,2
WE,20260501,1
""",
    "transfers.txt": """from_stop_id,to_stop_id,transfer_type,min_transfer_time
S1,S2,2,180
S2,S4,0,
S4,S9,,
""",
}

# other column order, blanks, a byte order mark, extra columns, a folder, CRLF, quotes
FEED_B = {
    "feed/agency.txt": "﻿agency_name,agency_id,agency_url,agency_timezone,motto\r\n"
    'Beta,B1,http://beta.example,UTC,"fast,\r\nsafe"\r\n',
    "feed/routes.txt": "route_type, route_id,route_short_name,route_long_name\r\n3,0010,10,Ring\r\n",
    "feed/trips.txt": "trip_id,route_id,service_id\r\n007,0010,S\r\n",
    "feed/stops.txt": "stop_lat, stop_id,stop_name,stop_lon\r\n"
    '50.0,001,"Old ""Mill""",4.0\r\n51.0,002,"Two\r\nLines",4.5\r\n',
    "feed/stop_times.txt": "stop_sequence, stop_id,trip_id,arrival_time,departure_time\r\n"
    "2,002,007,10:10:00,10:10:00\r\n1,001,007,9:00:00,9:00:00\r\n",
    "feed/calendar_dates.txt": "date,service_id,exception_type\r\n20260303,S,1\r\n20260101,S,1\r\n",
    "feed/readme.txt": "no table\r\n",
}


def variant(files: dict[str, str], **changed: str | None) -> dict[str, str]:
    """The files with some replaced, or removed by None; names without ``.txt``."""
    result = dict(files)
    for name, text in changed.items():
        if text is None:
            result.pop(f"{name}.txt")
        else:
            result[f"{name}.txt"] = text
    return result


FEED_DIRTY = variant(
    FEED_A,
    stops="""stop_id,stop_name,stop_lat,location_type
S1,first,48.1,1.0
S1,second,49.1,0
S2,two,x,1.5
,nameless,48.0,300
,other nameless,48.0,-2
S3,three,1e2,x
""",
)

FEED_ORPHANS = variant(
    FEED_A,
    trips="""route_id,service_id,trip_id
R1,WD,T1
R1,WD,T2
R9,WD,T3
R2,XX,T4
,WE,T5
""",
    stop_times=FEED_A["stop_times.txt"]
    + "T9,10:00:00,10:00:00,S1,1\nT9,10:05:00,10:05:00,S8,2\nT1,10:05:00,10:05:00,S8,4\n"
    + ",10:05:00,10:05:00,S1,5\n",
)


def write_archive(folder: Path, feed_id: str, files: dict[str, str]) -> Path:
    path = folder / f"mdb-{feed_id}" / "gtfs.zip"
    path.parent.mkdir(parents=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in files.items():
            if "/" in name and f"{name.split('/')[0]}/" not in archive.namelist():
                archive.writestr(f"{name.split('/')[0]}/", "")
            archive.writestr(name, text)
    return path


@pytest.fixture(scope="session")
def archive_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("archives")
    write_archive(folder, "0029", FEED_A)
    write_archive(folder, "b", FEED_B)
    write_archive(folder, "dirty", FEED_DIRTY)
    write_archive(folder, "orphans", FEED_ORPHANS)
    write_archive(folder, "nocal", variant(FEED_A, calendar=None, calendar_dates=None))
    write_archive(folder, "dates", variant(FEED_A, calendar=None))
    write_archive(folder, "empty", variant(FEED_A, routes=""))
    write_archive(folder, "headers", variant(FEED_A, transfers="from_stop_id,to_stop_id\n"))
    write_archive(folder, "short", variant(FEED_A, agency=None, trips=None))
    broken = folder / "mdb-broken"
    broken.mkdir()
    (broken / "gtfs.zip").write_text("this is no archive")
    return folder


@pytest.fixture(scope="session")
def cleaned(spark, archive_folder, tmp_path_factory):
    """The cleaned store of all archives: (cleaning result, raw folder, store folder)."""
    from headway.plans.clean_feeds import clean_feeds

    raw, out = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("clean")
    result = clean_feeds(spark, str(archive_folder), f"{raw}/r", f"{out}/c")
    return result, f"{raw}/r", f"{out}/c"


@pytest.fixture(scope="session")
def summary(spark, cleaned):
    from headway.plans.clean_feeds import load_tables
    from headway.plans.summarise import FeedSummary

    feeds = spark.createDataFrame(
        [("0029", "Alpha", "FR"), ("b", "Beta", "BE"), ("dates", "", "FR")],
        "feed_id string, provider string, country_code string",
    )
    tables = load_tables(spark, cleaned[2], feeds=feeds, feed_ids=["0029", "b", "dates"])
    return FeedSummary(tables).stored()


def rows(df, *columns):
    """Rows as tuples, sorted."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
