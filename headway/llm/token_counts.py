"""Token counts of documents in flat token files that have no index.

A token file is a stream of fixed-width ids; each document ends with a separator id. Here a
file is a table of blocks of equal length, cut wherever the block is full, so documents begin
and end anywhere. Every block is searched for separators by itself (vectorised); a prefix
scan over the blocks (running count of separators, running place of the last one) then gives
each block the number of its first document and where that began. The scan has two levels,
so that no task sees all blocks of a file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import column, slices, stored
from headway.llm.packing import encoder

SEPARATOR = 50256
BLOCK = 1 << 16  # ids in a block
GROUP = 1024  # blocks in a group of the first level


def ordinary_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text; names of special tokens in it are ordinary text."""
    return np.asarray(
        encoder(path).encode_to_numpy(text, allowed_special=set(), disallowed_special=()), "<u2"
    )


FILE_SCHEMA = "file long, block long, data binary, first long, doc_ids array<long>"


def write_token_files(docs: DataFrame, path: str, separator: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """One token file per task as blocks of ``block`` ids of two bytes, and beside them the
    doc_ids in file order (``data`` null; ``first`` is the number of the first one).

    A null text is an empty document. Only doc_id and text are read; equal rows are written
    as often as they occur.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, number, held, count, done = TaskContext.get().partitionId(), 0, [], 0, 0
        schema = pa.schema([
            ("file", pa.int64()), ("block", pa.int64()), ("data", pa.binary()),
            ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ])

        def rows(blocks: list, first: int | None, ids: list | None):
            n = len(blocks) + (ids is not None)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file] * n, pa.int64()),
                    pa.array([b for b, _ in blocks] + [None] * (n - len(blocks)), pa.int64()),
                    pa.array([d for _, d in blocks] + [None] * (n - len(blocks)), pa.binary()),
                    pa.array([None] * len(blocks) + [first] * (n - len(blocks)), pa.int64()),
                    pa.array([None] * len(blocks) + [ids] * (n - len(blocks)), pa.list_(pa.int64())),
                ],
                schema=schema,
            )

        for batch in batches:
            for part in slices(batch, "text"):
                ids = column(part, "doc_id").to_pylist()
                for text in column(part, "text").to_pylist():
                    found = ordinary_ids(text, path) if text else np.zeros(0, "<u2")
                    held += [found, np.array([separator], "<u2")]
                    count += len(found) + 1
                stream = np.concatenate(held)
                full = count // block
                blocks = [(done + i, stream[i * block : (i + 1) * block].tobytes()) for i in range(full)]
                held, count, done = [stream[full * block :]], count - full * block, done + full
                yield rows(blocks, number, ids)
                number += len(ids)
        if count:
            yield rows([(done, np.concatenate(held).tobytes())], None, None)

    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(run, FILE_SCHEMA)


def separators(blocks: DataFrame, separator: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """Per block (file, block): ``ids`` in it and the places in the file where it has a
    separator, found without looking at any other block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = column(batch, "block").to_numpy()
            sizes, places = [], []
            for number, data in zip(numbers, column(batch, "data")):
                ids = np.frombuffer(data.as_buffer(), "<u2")
                sizes.append(len(ids))
                places.append(np.flatnonzero(ids == separator) + int(number) * block)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "file"), column(batch, "block"), pa.array(sizes, pa.int64()),
                    pa.array(places, pa.list_(pa.int64())),
                ],
                names=["file", "block", "ids", "places"],
            )

    rows = blocks.filter("data is not null").select("file", "block", "data")
    return rows.mapInArrow(run, "file long, block long, ids long, places array<long>")


def token_counts(blocks: DataFrame, separator: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """Columns file, number (of the document in its file, from 0), start (its first id's place),
    n_tokens (without the separator) and ended.

    Ids behind the last separator of a file are a document with ``ended`` false. An empty
    file has no documents; two separators in a row enclose an empty document.
    """
    found = stored(separators(blocks, separator, block), "separators")
    group = F.floor(F.col("block") / GROUP).cast("long")
    found = found.select(
        "*", group.alias("group"), F.size("places").cast("long").alias("n"),
        F.when(F.size("places") > 0, F.element_at("places", -1)).otherwise(F.lit(-1)).cast("long").alias("last"),
    )
    groups = found.groupBy("file", "group").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    earlier = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "file", "group",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("last_before"),
    )
    inside = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = found.join(groups, ["file", "group"]).select(
        "file", "places",
        (F.col("n_before") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("number"),
        F.greatest("last_before", F.coalesce(F.max("last").over(inside), F.lit(-1))).alias("before"),
    )
    begins = F.concat(
        F.array(F.col("before") + 1),
        F.transform(F.expr("slice(places, 1, size(places) - 1)"), lambda p: p + 1),
    )
    ended = scanned.filter("size(places) > 0").select(
        "file", "number", F.posexplode(F.arrays_zip(begins.alias("begin"), F.col("places").alias("end"))).alias("i", "at")
    ).select(
        "file", (F.col("number") + F.col("i")).alias("number"), F.col("at.begin").alias("start"),
        (F.col("at.end") - F.col("at.begin")).alias("n_tokens"), F.lit(True).alias("ended"),
    )
    files = found.groupBy("file").agg(
        F.max(F.col("block") * block + F.col("ids")).alias("size"), F.sum("n").alias("number"),
        (F.max("last") + 1).alias("start"),
    )
    open_ = files.filter("size > start").select(
        "file", "number", "start", (F.col("size") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended")
    )
    return ended.union(open_)


def count_documents(docs: DataFrame, path: str, separator: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """Writes the documents to token files in the shared folder, counts, and names the
    documents again: doc_id, file, number, start, n_tokens."""
    files = stored(write_token_files(docs, path, separator, block), "tokens")
    names = files.filter("data is null").select(
        "file", "first", F.posexplode("doc_ids").alias("i", "doc_id")
    ).select("file", (F.col("first") + F.col("i")).alias("number"), "doc_id")
    return token_counts(files, separator, block).drop("ended").join(names, ["file", "number"]).select(
        "doc_id", "file", "number", "start", "n_tokens"
    )
