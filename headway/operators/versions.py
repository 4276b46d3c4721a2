"""What changed between two versions of a table, as multisets of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADDED, REMOVED = "added", "removed"


def row_changes(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that one version holds more often than the other: the columns, ``change`` (added or
    removed) and ``n`` (how often more).

    Rows are counted together with their version in one aggregation, in which NULL equals
    NULL; copies of a row are added up in every task before the exchange.
    """
    versions = old.select(*columns, F.lit(-1).alias("_n")).unionByName(
        new.select(*columns, F.lit(1).alias("_n"))
    )
    more = versions.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    change = F.when(F.col("_n") > 0, ADDED).otherwise(REMOVED)
    return more.select(*columns, change.alias("change"), F.abs("_n").cast("bigint").alias("n"))


def kept_rows(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of both versions with ``n``, how often both hold them (INTERSECT ALL, counted)."""
    versions = old.select(*columns, F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionByName(
        new.select(*columns, F.lit(0).alias("_old"), F.lit(1).alias("_new"))
    )
    counted = versions.groupBy(*columns).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    return counted.select(*columns, F.least("_old", "_new").alias("n")).where("n > 0")


def apply_changes(old: DataFrame, changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The new version, from the old one and ``row_changes``."""
    signed = F.when(F.col("change") == ADDED, F.col("n")).otherwise(-F.col("n"))
    versions = old.select(*columns, F.lit(1).cast("bigint").alias("_n")).unionByName(
        changes.select(*columns, signed.alias("_n"))
    )
    counted = versions.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n > 0")
    return counted.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n"))).drop("_n")


def changed_keys(changes: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key what happened to its rows: ``kind`` (added, removed or changed), rows added and
    removed, and the ``columns`` whose values differ where one row became another."""
    rest = [c for c in columns if c not in key]
    removed = F.col("change") == REMOVED
    sides = [
        F.min(F.when(removed == side, F.struct(*[F.col(c).cast("string").alias(c) for c in rest]))).alias(name)
        for name, side in (("_old", True), ("_new", False))
    ]
    grouped = changes.groupBy(*key).agg(
        F.coalesce(F.sum(F.when(~removed, F.col("n"))), F.lit(0)).alias("added"),
        F.coalesce(F.sum(F.when(removed, F.col("n"))), F.lit(0)).alias("removed"),
        *sides,
    )
    kind = F.when(F.col("removed") == 0, ADDED).when(F.col("added") == 0, REMOVED).otherwise("changed")
    differs = [
        F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in rest
    ]
    one = (F.col("added") == 1) & (F.col("removed") == 1)
    names = F.when(one, F.array_compact(F.array(*differs))).otherwise(F.array().cast("array<string>"))
    return grouped.select(*key, kind.alias("kind"), "added", "removed", names.alias("columns"))
