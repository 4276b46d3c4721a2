import datetime
import random

from conftest import rows

from headway.streaming.newest import follow_newest, newest, read_newest

SCHEMA = "k string, t timestamp, v int, w string"


def test_newest_whatever_the_order(spark, tmp_path):
    start = datetime.datetime(2026, 1, 1)
    r = random.Random(4)
    data = [
        (r.choice(["hot", "hot", "a", "b", "c", None]), start + datetime.timedelta(minutes=r.randint(0, 5000)), i % 50, "x")
        for i in range(600)
    ]
    data += [("tie", start, 3, "a"), ("tie", start, 3, "b"), ("late", start, 1, None), ("a", None, 9, "z")]
    df = spark.createDataFrame(data, SCHEMA)
    want = rows(newest(df, "k", "t", ["v", "w"], "v int, w string"))
    best = {}
    for k, t, v, w in data:
        if k is not None and t is not None:
            best[k] = max(best.get(k, (t,)), (t,))
    assert {k: (t,) for k, t, *_ in want} == best and ("tie", start, 3, "b") in want and ("late", start, 1, None) in want
    for order in range(2):
        base = tmp_path / str(order)
        mixed = random.Random(order).sample(data, len(data))
        for half in (mixed[:350], mixed[350:]):  # a restart in between
            spark.createDataFrame(half, SCHEMA).repartition(3).write.mode("append").parquet(str(base / "in"))
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(base / "in"))
            follow_newest(
                stream, "k", "t", ["v", "w"], str(base / "out"), str(base / "mark"), quiet_seconds=1
            )
        assert rows(read_newest(spark, str(base / "out"), "k", "t", "v int, w string")) == want, order


def test_no_new_files_change_nothing(spark, tmp_path):
    df = spark.sql("select 'a' k, timestamp'2026-01-01' t, 1 v, 'x' w")
    df.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        follow_newest(stream, "k", "t", ["v", "w"], str(tmp_path / "out"), str(tmp_path / "mark"))
    assert read_newest(spark, str(tmp_path / "out"), "k", "t", "v int, w string").count() == 1
