"""Helpers of the operators: tables, stored results, row numbers, words of whole texts."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.session import shared_folder

# Bytes of text that one numpy step works on; bounds the memory of a task.
STEP_BYTES = 2 << 20
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: later steps do not repeat
    them, and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/headway-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Rows numbered 0..N-1 in the given order, sorted by ranges over many tasks.

    The sorted rows are stored, so that partitions do not change between counting and
    numbering; the offsets are one row per stored partition. Pass narrow rows.
    """
    place = F.struct(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    kept = stored(df.orderBy(*order).withColumn("_place", place), "numbered")
    part = F.col("_place.part")
    sizes = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.col("_place.at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        kept.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # one row per sort partition
        .withColumn(name, (F.col("_start") + within).cast("bigint"))
        .drop("_place", "_part", "_start")
    )


def row_key(*columns: str) -> Column:
    """A long that tells rows apart by content; equal rows share it."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in columns])


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers (splitmix finaliser), in place where possible."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _odd(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


_BYTE = _odd(256, 11)
_PLACE = _odd(64, 23)
_BASE = U64(0x9E3779B97F4A7C15 | 1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def separator_table(blanks: bytes = BLANKS) -> np.ndarray:
    """True for bytes that belong to words when all but these separate."""
    inside = np.ones(256, dtype=bool)
    inside[list(blanks)] = False
    return inside


@dataclass
class Words:
    """Words of some texts: hash, byte range in the joined buffer, and per text its first."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # length: texts + 1
    buffer: np.ndarray
    offsets: np.ndarray  # byte range of texts in the buffer, length: texts + 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts joined, and the offsets; null counts as empty."""
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    buffer = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return buffer, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of text; a longer text is one piece."""
    if batch.num_rows == 0:
        return
    _, offsets = bytes_of(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def hashes_of_runs(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges are in order, apart and not empty."""
    if not len(starts):
        return np.zeros(0, U64)
    out, at = [], 0
    while at < len(starts):
        upto = int(np.searchsorted(ends, starts[at] + STEP_BYTES, side="right"))
        upto = max(upto, at + 1)
        s, e = starts[at:upto], ends[at:upto]
        length = e - s
        heads = np.concatenate(([0], np.cumsum(length)[:-1]))
        within = np.arange(int(length.sum())) - np.repeat(heads, length)
        value = _BYTE[buffer[within + np.repeat(s, length)]]
        longest = int(length.max())
        place = _PLACE
        if longest > len(place):
            place = np.concatenate((place, _odd(longest, 23)[len(place) :]))
        value = value * place[within]
        out.append(np.add.reduceat(value, heads) + length.astype(U64) * _BASE)
        at = upto
    return mixed(np.concatenate(out))


def words_of(
    texts: pa.Array, inside: np.ndarray | None = None, lower: bool = True
) -> Words:
    """All words of all texts: longest runs of bytes that ``inside`` marks.

    Byte classes do for words of UTF-8 text as long as bytes from 0x80 are all inside.
    """
    inside = separator_table() if inside is None else inside
    buffer, offsets = bytes_of(texts)
    if lower:
        buffer = LOWER[buffer]
    mask = inside[buffer]
    change = np.flatnonzero(mask[1:] != mask[:-1]) + 1 if len(mask) else np.zeros(0, np.int64)
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(mask))] if len(mask) else cuts[:0]
    edges = np.unique(np.concatenate(([0], change, cuts, [len(mask)])))
    s, e = edges[:-1], edges[1:]
    word = mask[s] if len(s) and len(mask) else np.zeros(len(s), bool)
    s, e = s[word], e[word]
    first = np.searchsorted(s, offsets, side="left")
    return Words(hashes_of_runs(buffer, s, e), s, e, first, buffer, offsets)


def window_hashes(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of n words within a text, and the place of their first word."""
    if len(hashes) < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    total = np.zeros(len(hashes) - n + 1, U64)
    for j, factor in enumerate(_odd(n, 31 + n)):
        total += hashes[j : len(hashes) - n + 1 + j] * factor
    ends = np.repeat(first[1:], np.diff(first))[: len(total)]
    at = np.flatnonzero(np.arange(len(total)) + n <= ends)
    return mixed(total[at]), at


def shingle_sets(words: Words, n: int = 5) -> list[np.ndarray]:
    """Per text its distinct n-word shingles, sorted; a shorter text is one shingle."""
    hashes, at = window_hashes(words.hashes, words.first, n)
    bounds = np.searchsorted(at, words.first)
    sets = []
    for row in range(len(words.first) - 1):
        a, b = words.first[row], words.first[row + 1]
        if b - a >= n:
            sets.append(np.unique(hashes[bounds[row] : bounds[row + 1]]))
        elif b > a:
            whole, _ = window_hashes(words.hashes[a:b], np.array([0, b - a]), int(b - a))
            sets.append(whole)
        else:
            sets.append(np.zeros(0, U64))
    return sets


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, one table each; a group may span batches."""
    pending: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        marks = np.stack([column(batch, k).to_numpy(zero_copy_only=False) for k in keys])
        cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            mark = tuple(marks[:, a].tolist())
            if pending and mark != last:
                yield pa.Table.from_batches(pending)
                pending = []
            pending.append(batch.slice(a, b - a))
            last = mark
    if pending:
        yield pa.Table.from_batches(pending)
