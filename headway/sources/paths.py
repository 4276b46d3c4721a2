"""Values and paths in JSON documents of unlike shape, without a scan for a schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.session import materialise

# What a value is called by the type that is held.
KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}


def parse_documents(df: DataFrame, column: str, name: str = "document") -> DataFrame:
    """The text of a column as a VARIANT; NULL where it is no JSON."""
    return df.withColumn(name, F.try_parse_json(F.col(column)))


def values_at(df: DataFrame, paths: Mapping[str, tuple[str, str]], document: str = "document") -> DataFrame:
    """A column per name with the value at its path, as its type (``{name: (path, type)}``).

    A path that leads nowhere, or to a value that does not fit the type, gives NULL; an object or
    array as a string is its JSON.
    """
    found = {name: F.try_variant_get(F.col(document), path, kind) for name, (path, kind) in paths.items()}
    return df.withColumns(found)


def _kind(value):
    kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    known = F.create_map(*[F.lit(x) for item in KINDS.items() for x in item])
    return F.coalesce(F.try_element_at(known, kind), F.lit("number"))


def leaves(df: DataFrame, identity: str, document: str = "document") -> DataFrame:
    """Every leaf of every document: the identity, ``path``, ``kind``, and the value as
    ``text``. Places in arrays are written ``[*]``. Empty objects and arrays are leaves.

    One level is opened at a time, in as many rounds as the deepest document has levels; the
    rows of a level are kept, so none is opened twice.
    """
    spark = df.sparkSession
    level = df.where(F.col(document).isNotNull()).select(
        identity, F.lit("$").alias("path"), F.col(document).alias("value")
    )
    result = None
    while True:
        level = materialise(level.withColumn("kind", _kind(F.col("value"))))
        inner = spark.sql(
            "SELECT l.*, c.pos, c.key, c.value AS child FROM {level} l,"
            " LATERAL variant_explode_outer(l.value) AS c",
            level=level,
        )
        closed = inner.where("child IS NULL").select(
            identity, "path", "kind",
            F.when(~F.col("kind").isin("object", "array", "null"), F.try_variant_get("value", "$", "string")).alias("text"),
        )
        result = closed if result is None else result.unionByName(closed)
        step = F.when(F.col("key").isNull(), F.lit("[*]")).otherwise(F.concat(F.lit("."), F.col("key")))
        level = inner.where("child IS NOT NULL").select(
            identity, F.concat("path", step).alias("path"), F.col("child").alias("value")
        )
        if level.isEmpty():
            return result


def path_report(found: DataFrame, identity: str) -> DataFrame:
    """Per path and kind of ``leaves``: how many documents have it, and how many values."""
    return found.groupBy("path", "kind").agg(
        F.countDistinct(identity).alias("documents"), F.count(F.lit(1)).alias("n")
    )
