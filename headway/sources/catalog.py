"""The CSV catalog of published feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """All catalog entries as text, empty cells as NULL.

    A dotted column such as ``location.country_code`` is named by its last part.
    ``mdb_source_id`` is a number, so that entries sort as in the catalog.
    """
    raw = (
        spark.read.option("header", "true")
        .option("multiLine", "true")
        .option("escape", '"')
        .csv(path)
    )
    named = raw.toDF(*[c.strip().split(".")[-1] for c in raw.columns])
    texts = [F.nullif(F.col(c), F.lit("")).alias(c) for c in named.columns]
    catalog = named.select(*texts)
    if "mdb_source_id" in catalog.columns:
        number = F.col("mdb_source_id").try_cast("double").cast("bigint")
        catalog = catalog.withColumn("mdb_source_id", number)
    return catalog
