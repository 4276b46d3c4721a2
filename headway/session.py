"""Session helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LISTING_SETTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# Settings for large clusters, for the session builder. Exchanges start with many small
# partitions that adaptive execution merges to the advised size, splits where a key is
# hot, and turns into broadcasts where a side proves to be small.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.session.timeZone": "UTC",
}


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the cluster.

    Where the setting is absent, a folder below the warehouse path is taken, which all
    executors share as well.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    if spark.sparkContext.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        spark.sparkContext.setCheckpointDir(f"{warehouse}/_checkpoints")
    return spark.sparkContext.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are stored once and survive lost executors."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def kept(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The rows as a table of known size: a small one is broadcast where it is joined, a large
    one is not. One in a ``folder`` that is removed later is packed more tightly."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/headway-{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd") if folder else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of tables that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession):
    """Rows exchanged by what is written inside leave the disks when it is done, not when the
    driver happens to collect garbage."""
    return _set(spark, CLEANUP_SETTING, "true")


def folders_listed(spark: SparkSession):
    """Some tasks per core list many folders of a file or two, not one task each."""
    return _set(spark, LISTING_SETTING, str(4 * spark.sparkContext.defaultParallelism))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system Spark can reach."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(hadoop)
