"""Canonical columns, types and unique keys of feed tables, and what cleaning changed."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions.scalars import number, whole_number
from headway.operators.single import beside
from headway.schema import COPIES, FEED, LOST, POSITION, SPREAD, TABLES, TableSpec

# rows that are searched for copies at a time, and more where a block has more
ROWS_AT_ONCE = 50_000


def trim_headers(df: DataFrame) -> DataFrame:
    """Column names without surrounding blanks."""
    return df.toDF(*[c.strip() for c in df.columns])


def canonical_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The columns of the specification in its order, absent ones as NULL.

    The feed id, the row position and the spread are carried along where present.
    """
    carried = [c for c in (FEED, POSITION, SPREAD) if c in df.columns]
    # dotted or odd names are never canonical, so plain lookup by name is safe
    own = [
        F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
        for c in spec.columns
    ]
    return df.select(*carried, *own)


def typed(c: Column, kind: str) -> Column:
    """Text as a canonical type, NULL where it does not fit."""
    if kind == "string":
        return c.cast("string")
    if kind == "double":
        return number(c)
    return whole_number(c, kind)


def coerce_types(df: DataFrame, spec: TableSpec, lost: str | None = None) -> DataFrame:
    """Text columns cast to the types of the specification.

    ``lost`` names an extra column with the number of values of a row that were given
    but did not fit their type.
    """
    columns = [c for c in spec.columns if c in df.columns]
    other = [F.col(c) for c in df.columns if c not in columns]
    result = [typed(F.col(c), spec.type_of(c)).alias(c) for c in columns]
    if lost:
        unfit = [
            F.when(F.col(c).isNotNull() & typed(F.col(c), spec.type_of(c)).isNull(), 1).otherwise(0)
            for c in columns
            if spec.type_of(c) != "string"
        ]
        result.append(sum(unfit, F.lit(0)).alias(lost))
    return df.select(*other, *result)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in the given order; NULL keys count as equal.

    ``row_number() = 1`` lets Spark cut every key to one row per task before the
    shuffle, so a key holding a large part of all rows costs no more than any other.
    """
    if not key:
        return df
    first = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")


def dedupe_keep_first(
    df: DataFrame, spec: TableSpec, order: Sequence[str | Column] = (POSITION,)
) -> DataFrame:
    """Unique primary keys per feed, the first row in file order staying."""
    key = [c for c in spec.key if c in df.columns]
    return keep_first(df, [FEED, *key] if key else [], order)


def _run_start(rows: pa.Table) -> int:
    """Where the rows of the last feed and part begin."""
    part = pc.struct_field(rows[POSITION], "part")
    start = 0
    for column in (rows[FEED], part):
        last = column[-1]
        same = pc.is_null(column) if last.as_py() is None else pc.fill_null(pc.equal(column, last), False)
        others = np.flatnonzero(~same.to_numpy(zero_copy_only=False))
        start = max(start, int(others[-1]) + 1 if len(others) else 0)
    return start


def _merged(rows: pa.Table, key: Sequence[str]) -> pa.Table:
    """Copies of a key in a part as one row, with what ``merge_copies`` counts."""
    place = rows[POSITION].combine_chunks()
    order = np.argsort(pc.struct_field(place, "row").to_numpy(zero_copy_only=False), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    keyed = pa.table(
        [rows[FEED], pc.struct_field(place, "part"), *[rows[k] for k in key], pa.array(rank), rows[LOST]],
        names=["f", "p", *[f"k{i}" for i in range(len(key))], "rank", "lost"],
    )
    found = keyed.group_by(keyed.column_names[:-2], use_threads=False).aggregate(
        [("rank", "min"), ("rank", "count"), ("lost", "sum")]
    )
    if len(found) == len(rows):
        return rows.append_column(COPIES, pa.array(np.ones(len(rows), np.int64)))
    first = order[found["rank_min"].to_numpy()]
    kept = np.argsort(first)
    counted = found.take(pa.array(kept))
    unique = rows.take(pa.array(first[kept]))
    unique = unique.set_column(unique.column_names.index(LOST), LOST, counted["lost_sum"])
    return unique.append_column(COPIES, counted["rank_count"])


def merge_copies(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Unique keys within every part of a feed's file: the first row, in ``_copies`` how many
    rows it stands for, in ``_lost`` the sum of theirs; NULL keys count as equal.

    Nothing is exchanged: the rows of a part have to follow each other. Where they do not,
    some copies stay.
    """
    key = list(key)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < ROWS_AT_ONCE or not batch.num_rows:
                continue
            rows = pa.Table.from_batches(held)
            start = _run_start(rows)
            if start:
                yield from _merged(rows.slice(0, start), key).to_batches()
                rest = rows.slice(start)
                held, n = rest.to_batches(), rest.num_rows
        if n:
            yield from _merged(pa.Table.from_batches(held), key).to_batches()

    return df.mapInArrow(merge, T.StructType([*df.schema.fields, T.StructField(COPIES, T.LongType())]))


def row_counts(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(FEED).agg(F.count(F.lit(1)).alias(name))


def cleaning_stats(
    raw: DataFrame, clean: DataFrame, spec: TableSpec, headers: DataFrame | None = None
) -> DataFrame:
    """Per feed: rows before and after, duplicates removed, columns kept and dropped.

    ``headers`` holds the source column names per feed (``feed_id``, ``header ARRAY``).
    A column ``_lost`` of ``raw`` is summed up as ``n_coerced_null``.
    """
    lost = F.sum("_lost") if "_lost" in raw.columns else F.lit(0)
    before = raw.groupBy(FEED).agg(
        F.count(F.lit(1)).alias("rows_raw"), lost.cast("bigint").alias("n_coerced_null")
    )
    stats = (
        before.join(row_counts(clean, "rows_cleaned"), FEED, "left")
        .withColumn("rows_cleaned", F.coalesce("rows_cleaned", F.lit(0)))
        .withColumn("duplicates_removed", F.col("rows_raw") - F.col("rows_cleaned"))
        .withColumn("table", F.lit(spec.name))
    )
    if headers is None:
        return stats
    canonical = F.array(*[F.lit(c) for c in spec.columns])
    required = F.array(*[F.lit(c) for c in spec.required])
    named = headers.select(
        FEED,
        # missing required columns are added behind those the source has
        F.array_distinct(
            F.concat(F.array_intersect(canonical, F.col("header")), required)
        ).alias("columns_kept"),
        F.array_sort(F.array_except("header", canonical)).alias("columns_dropped"),
    )
    return stats.join(named, FEED, "left")


def cleaning_report(stats: DataFrame, feeds: DataFrame) -> DataFrame:
    """One row over all feeds: how many succeeded and failed, and the rows cleaned.

    ``feeds`` has one row per feed with a boolean ``success``.
    """
    counted = TABLES.keys() & {"routes", "stops", "trips", "stop_times"}
    rows = stats.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("table") == t, F.col("rows_cleaned"))), F.lit(0)).alias(
                f"total_{t}"
            )
            for t in sorted(counted)
        ]
    )
    success = feeds.agg(
        F.count(F.lit(1)).alias("total_feeds"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
    )
    return beside(success, rows)
