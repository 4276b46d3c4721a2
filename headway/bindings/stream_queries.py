"""Queries on streams: the events as files that arrive in a mixed order."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from headway.bindings.registry import query
from headway.session import shared_folder
from headway.streaming.newest import follow_newest, read_newest

PARTS = 6
_FURTHER = "event_id bigint, event_type string, value double"


@query(
    "newest_events",
    """
    SELECT user_id, max(ts) AS ts, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type,
           arg_max(value, ts) AS value
    FROM events GROUP BY user_id""",
)
def _(b):
    """Two runs of one stream; files of the second one hold events of any age."""
    base = f"{shared_folder(b.spark)}/newest-{uuid.uuid4().hex}"
    events = b.raw("events").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type", "value"
    )
    # files by a hash, so that each holds late and early events
    mixed = events.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(PARTS)))
    for run, parts in enumerate((range(PARTS // 2), range(PARTS // 2, PARTS))):
        arrived = mixed.where(F.col("part").isin(*parts)).drop("part")
        arrived.repartition(len(parts), "event_id").write.mode("append").parquet(f"{base}/in")
        stream = b.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        follow_newest(
            stream, "user_id", "ts", ["event_id", "event_type", "value"], f"{base}/out", f"{base}/mark"
        )
    found = read_newest(b.spark, f"{base}/out", "user_id", "ts", _FURTHER)
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
