"""The newest row of every key by event time, whatever the order of arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARRIVED = "_arrived"
ROW = "_row"  # the further columns of a row as JSON, whose order decides between equal times


def _packed(rows: DataFrame, key: str, time: str, columns: Sequence[str]) -> DataFrame:
    packed = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return rows.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key), F.col(time), packed.alias(ROW)
    )


def changes_of_newest(
    rows: DataFrame, key: str, time: str, columns: Sequence[str], quiet_seconds: int
) -> DataFrame:
    """A stream of the rows that became the newest of their key: key, time and the others as JSON.

    State holds one row per key and stretch of ``quiet_seconds`` of arrival: when a stretch is over,
    its rows are dropped. A row that arrives after that is passed on again, as is the newest one of a
    batch without news, so what is kept must itself prefer later times, as ``read_newest`` does. The
    watermark follows the time of arrival: one on ``time`` would drop a key whose newest row is
    older than the rows of others, and make the result depend on the order of arrival. Rows of a
    batch are reduced in every task before they meet by key, so a hot key sends one row per task.
    Rows without key or time are left out.
    """
    arriving = _packed(rows, key, time, columns).withColumn(ARRIVED, F.current_timestamp())
    stretch = F.window(ARRIVED, f"{quiet_seconds} seconds")
    found = arriving.withWatermark(ARRIVED, "1 minute").groupBy(key, stretch).agg(
        F.max(F.struct(time, ROW)).alias("_best")
    )
    return found.select(key, F.col(f"_best.{time}").alias(time), F.col(f"_best.{ROW}").alias(ROW))


def follow_newest(
    rows: DataFrame,
    key: str,
    time: str,
    columns: Sequence[str],
    out: str,
    checkpoint: str,
    quiet_seconds: int = 86_400,
) -> None:
    """Adds what a stream has got since the last run to the rows below ``out``, then returns.

    A batch that is repeated after a failure replaces its own folder.
    """
    changes = changes_of_newest(rows, key, time, columns, quiet_seconds)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    changes.writeStream.foreachBatch(write).outputMode("update").option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()


def read_newest(spark: SparkSession, out: str, key: str, time: str, schema: str) -> DataFrame:
    """The newest row of every key so far; ``schema`` is that of its further columns."""
    found = spark.read.parquet(out).groupBy(key).agg(F.max(F.struct(time, ROW)).alias("_best"))
    return found.select(key, F.col(f"_best.{time}").alias(time), F.from_json(f"_best.{ROW}", schema).alias(ROW)).select(
        key, time, f"{ROW}.*"
    )


def newest(rows: DataFrame, key: str, time: str, columns: Sequence[str], schema: str) -> DataFrame:
    """The same of a table at once."""
    found = _packed(rows, key, time, columns).groupBy(key).agg(F.max(F.struct(time, ROW)).alias("_best"))
    return found.select(key, F.col(f"_best.{time}").alias(time), F.from_json(f"_best.{ROW}", schema).alias(ROW)).select(
        key, time, f"{ROW}.*"
    )
