"""Removal of repeated byte strings by a distributed merge sort of suffixes.

A window of 200 bytes is repeated if the same bytes start anywhere else; all bytes of repeated
windows go. Windows are not exchanged one by one. Each is represented by an anchor, the first of its
32-byte grams with the least hash, which depends on the window's bytes only: equal windows have
equal anchors at equal offsets. Consecutive windows of one anchor form a stretch, and what is
sorted is the suffix of the text at the anchor, as long as the stretch needs it, followed by the
bytes before the anchor in reverse.

1. Equal texts become one with a count, in a table bucketed by content, so that the later joins by
   content exchange no texts.
2. Grams of anchors are counted by hash over all texts; stretches whose gram stands once in all hold
   no repeated window. (Equal hashes of different grams only cost work.)
3. The other suffixes are sorted in runs of bounded size, written front-coded (length of the
   prefix shared with the predecessor, then the rest), cut by ranges of the order, and exchanged.
4. Each range merges its runs with a loser tree that knows of every head how much it shares with
   the last output: heads that share different amounts are ordered by these numbers alone, others
   are compared from the known prefix on. The merged lengths tell which neighbours share
   what after the anchor; comparing what stands before it gives the repeated windows exactly.

The order puts a hash of the leading gram before it, so ranges are even without sampling. Equal
strings of a run are one entry with a count and need no answer, so a passage in every document
sends one entry per run. Where more than ``HOT`` texts share a gram, windows of its stretches
are sorted singly: then all entries of a gram are equal but for the hash, and spread over ranges.
Where a range has more than ``FAN_IN`` runs, groups of runs are merged first.

A null text is empty, texts shorter than a window keep all bytes, repeated rows lose all windows. Very
long texts are read in pieces that overlap by a window. An empty table gives no rows. Only doc_id
and text are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import U64, bytes_of, column, mixed, slices, stored
from headway.session import shared_folder

GRAM = 32
PIECE = 1 << 20  # bytes of a text whose windows are looked at together
RUN_BYTES = 16 << 20  # strings of one sorted run
RANGE_BYTES = 32 << 20  # strings that one range merges, about
FAN_IN = 1024
HOT = 50_000
PAIRS = 64  # strings of a gram up to which they are compared in pairs

_GRAM_BYTE = mixed(np.arange(1, 257, dtype=U64))
_FACTOR = U64(0x9E3779B97F4A7C15)
_HIGH = U64(0xFFFFFFFFFF000000)

ANSWER = "gram long, key binary, at long"
RUNS = "range long, run long, entries binary, key binary, found binary"


def _gram_hashes(buffer: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes at every place."""
    value, size, factor = _GRAM_BYTE[buffer], 1, int(_FACTOR)
    while size < GRAM:
        value = value[:-size] * U64(factor) + value[size:]
        factor, size = factor * factor & 0xFFFFFFFFFFFFFFFF, size * 2
    return mixed(value)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, by prefixes and suffixes of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, U64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Stretches:
    """Consecutive windows of equal anchor: first and last window, anchor, hash of its gram."""

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray, window: int):
        """Of all texts of a buffer of less than 16 MB, or of one piece of a text."""
        empty = np.zeros(0, np.int64)
        self.first = self.last = self.anchor = self.text = empty
        self.gram = np.zeros(0, U64)
        if len(buffer) < window:
            return
        hashes = _gram_hashes(buffer)
        # the place in the low bits makes the first of equal grams the least
        marked = (hashes & _HIGH) | np.arange(len(hashes), dtype=U64)
        least = _sliding_least(marked, window - GRAM + 1)
        count = np.maximum(np.diff(offsets) - window + 1, 0)
        text = np.repeat(np.arange(len(count)), count)
        starts = np.arange(len(text)) + np.repeat(offsets[:-1] - (np.cumsum(count) - count), count)
        if not len(starts):
            return
        anchors = (least[starts] & ~_HIGH).astype(np.int64)
        new = np.flatnonzero((anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])) + 1
        heads = np.concatenate(([0], new))
        self.first, self.last = starts[heads], starts[np.concatenate((new, [len(starts)])) - 1]
        self.anchor, self.text = anchors[heads], text[heads]
        # the least hashes of windows are small; mixed once more they fill the whole range
        self.gram = mixed(hashes[self.anchor])


def _pieces(texts: pa.Array, window: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts together, or pieces of a long one: row, place in it, buffer, offsets."""
    buffer, offsets = bytes_of(texts)
    if len(buffer) <= 2 * PIECE or len(offsets) > 2:
        yield 0, 0, buffer, offsets
        return
    for at in range(0, len(buffer) - window + 1, PIECE):
        part = buffer[at : at + PIECE + window - 1]
        yield 0, at, part, np.array([0, len(part)])


def _asker(window: int) -> Callable:
    """Anchors of all texts: hash of the gram, the text's key, place of the anchor."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", PIECE):
                keys = column(batch, "key")
                for _, at, buffer, offsets in _pieces(column(batch, "text"), window):
                    found = Stretches(buffer, offsets, window)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(found.gram.view(np.int64)), keys.take(pa.array(found.text)),
                            pa.array(at + found.anchor - offsets[found.text]),
                        ],
                        names=["gram", "key", "at"],
                    )

    return ask


# An entry is a string, split at the anchor, with how often it stands in the run and, if
# once, whom to answer: key of the text and place of the anchor in it. The sort key is
# hash of the gram (8 bytes), bytes from the anchor on, bytes before it reversed.
ENTRY = struct.Struct(">HHHB")  # shared with the predecessor, length, of it before the anchor, owned
OWNER = struct.Struct(">16sq")


def encode_run(entries: list[tuple]) -> bytes:
    """Front-coded entries (sort key, bytes before the anchor, owner or None)."""
    out, last = [], b""
    for key, before, owner in entries:
        shared = diverge(last, key, 0)
        out.append(ENTRY.pack(shared, len(key), before, owner is not None))
        if owner is not None:
            out.append(OWNER.pack(*owner))
        out.append(key[shared:])
        last = key
    return b"".join(out)


def decode_run(data: bytes) -> Iterator[tuple]:
    """(shared with the predecessor, sort key, bytes before the anchor, owner or None)."""
    at, last, size = 0, b"", len(data)
    while at < size:
        shared, length, before, owned = ENTRY.unpack_from(data, at)
        at += ENTRY.size
        owner = None
        if owned:
            owner = OWNER.unpack_from(data, at)
            at += OWNER.size
        last = last[:shared] + data[at : at + length - shared]
        at += length - shared
        yield shared, last, before, owner


def diverge(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that share ``known`` bytes."""
    end = min(len(a), len(b))
    x, y = a[known:end], b[known:end]
    if x == y:
        return end
    low, high = 0, len(x)  # x[:low] == y[:low], x[:high] != y[:high]
    step = 8
    while low + step < high and x[low : low + step] == y[low : low + step]:
        low += step
        step *= 2
    high = min(high, low + step)
    while high - low > 1:
        middle = (low + high) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle
    return known + low


def merge(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Entries of sorted runs in order, each with what it shares with the entry before it.

    A loser tree: every inner node keeps the head that lost there and how much of it is shared
    with the winner that passed. After an output, the new head of its run plays up its path; both
    heads of a match share known lengths with the same last output, so the longer one wins,
    and only if they are equal bytes are compared, from that length on.
    """
    k = len(runs)
    heads: list[tuple | None] = [next(r, None) for r in runs]
    shared = [0] * k  # with the last output

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; sets what the loser shares with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = shared[a], shared[b]
        if p != q:
            # the one that shares more is smaller; the other shares with it what it shared before
            return (a, b) if p > q else (b, a)
        m, n = x[1], y[1]
        p = diverge(m, n, p)
        if m[p : p + 1] <= n[p : p + 1]:
            shared[b] = p
            return a, b
        shared[a] = p
        return b, a

    size = 1
    while size < k:
        size *= 2
    heads += [None] * (size - k)
    shared += [0] * (size - k)
    losers = [0] * size
    level = list(range(size))
    node = size
    while len(level) > 1:
        node //= 2
        following = []
        for i in range(0, len(level), 2):
            winner, loser = play(level[i], level[i + 1])
            losers[node + i // 2] = loser
            following.append(winner)
        level = following
    winner = level[0]
    while heads[winner] is not None:
        _, key, before, owner = heads[winner]
        yield shared[winner], key, before, owner
        heads[winner] = head = next(runs[winner], None)
        shared[winner] = head[0] if head is not None else 0
        node = (size + winner) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def collapse(merged: Iterable[tuple], release: Callable) -> Iterator[tuple]:
    """Equal strings as one without an owner; owners of equal ones are released, as all
    windows of their strings are repeated. Yields shared, sort key, before, owner."""
    last = None
    for shared, key, before, owner in merged:
        if last is not None and before == last[2] and len(key) == len(last[1]) == shared:
            if last[3] is not None:
                release(last)
            if owner is not None:
                release((shared, key, before, owner))
            last = (*last[:3], None)
            continue
        if last is not None:
            yield last
        last = (shared, key, before, owner)
    if last is not None:
        yield last


def repeated_windows(group: list[tuple], window: int) -> list[int]:
    """For the different strings of one gram, in order: which windows are repeated, as bits by
    the distance of the window's start before the anchor."""
    n = len(group)
    after = [len(key) - 8 - before for _, key, before, _ in group]
    masks = [0] * n
    left = [key[len(key) - before :] for _, key, before, _ in group]
    if n <= PAIRS:
        for i in range(n - 1):
            right = 1 << 30
            for j in range(i + 1, n):
                right = min(right, group[j][0] - 8)
                low = window - min(right, after[i], after[j])
                if low > min(len(left[i]), len(left[j])):
                    continue
                high = diverge(left[i], left[j], 0)
                if high >= low:
                    found = (1 << high + 1) - (1 << low)
                    masks[i] |= found
                    masks[j] |= found
        return masks
    shared = np.array([s - 8 for s, *_ in group])
    shared[0] = 0
    order = sorted(range(n), key=left.__getitem__)
    before = np.array([len(x) for x in left])
    rows = np.array(order)
    alike = np.array([0] + [diverge(left[a], left[b], 0) for a, b in zip(order, order[1:])])
    low = window - np.array(after)
    for distance in range(int(low.min()), int(before.max()) + 1):
        able = np.flatnonzero((low <= distance) & (before >= distance))
        if len(able) < 2:
            continue
        by_right = np.cumsum(shared < window - distance)
        by_left = np.zeros(n, np.int64)
        by_left[rows] = np.cumsum(alike < distance)
        classes = by_right[able] * n + by_left[able]
        _, which, count = np.unique(classes, return_inverse=True, return_counts=True)
        for i in able[count[which] > 1].tolist():
            masks[i] |= 1 << distance
    return masks


def _spans_of(mask: int) -> Iterator[tuple[int, int]]:
    """Runs of set bits, as lowest and highest."""
    at = 0
    while mask:
        zeros = (mask & -mask).bit_length() - 1
        mask >>= zeros
        ones = (~mask & mask + 1).bit_length() - 1
        yield at + zeros, at + zeros + ones - 1
        mask >>= ones
        at += zeros + ones


class _Found:
    """Repeated windows by text: first and last start, packed."""

    def __init__(self):
        self.of: dict[bytes, list[int]] = {}

    def add(self, key: bytes, first: int, last: int) -> None:
        self.of.setdefault(key, []).extend((first, last))

    def release(self, entry: tuple, window: int) -> None:
        _, sort_key, before, (key, at) = entry
        self.add(key, at - before, at + len(sort_key) - 8 - before - window)

    def rows(self) -> list[tuple]:
        rows = [(None, None, None, k, np.array(v, np.int64).tobytes()) for k, v in self.of.items()]
        self.of = {}
        return rows


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, types)],
        names=["range", "run", "entries", "key", "found"],
    )


def _run_rows(entries: list[tuple], run: int, ranges: int) -> list[tuple]:
    """The sorted entries cut by ranges of the leading hash, front-coded."""
    rows, start = [], 0
    of = [int.from_bytes(e[0][:8], "big") * ranges >> 64 for e in entries]
    for i in range(1, len(entries) + 1):
        if i == len(entries) or of[i] != of[start]:
            rows.append((of[start], run, encode_run(entries[start:i]), None, None))
            start = i
    return rows


def _sorter(window: int, ranges: int, run_bytes: int) -> Callable:
    """Sorted runs of the suffixes at asked anchors; windows already seen twice in a run."""

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: dict[tuple[bytes, int], tuple | None] = {}
        found, size = _Found(), 0

        def take(text: bytes, first: int, last: int, anchor: int, gram: bytes, owner, several: bool) -> int:
            key = gram + text[anchor : last + window] + text[first:anchor][::-1]
            before = anchor - first
            if (key, before) not in strings:
                strings[key, before] = None if several else owner
                return len(key) + 100
            for one in (strings[key, before], None if several else owner):
                if one is not None:
                    found.release((0, key, before, one), window)
            strings[key, before] = None
            return 50

        def flush() -> pa.RecordBatch:
            entries = sorted((key, before, owner) for (key, before), owner in strings.items())
            strings.clear()
            run = uuid.uuid4().int >> 65
            return _rows(_run_rows(entries, run, ranges) + found.rows())

        for whole in batches:
            for batch in slices(whole, "text", PIECE):
                keys = column(batch, "key").to_pylist()
                several = [c > 1 for c in column(batch, "copies").to_pylist()]
                asked = [np.array(a, np.int64) for a in column(batch, "asked").to_pylist()]
                for _, at, buffer, offsets in _pieces(column(batch, "text"), window):
                    data = buffer.tobytes()
                    s = Stretches(buffer, offsets, window)
                    places = at + s.anchor - offsets[s.text]
                    for row in range(len(offsets) - 1):
                        a, b = np.searchsorted(s.text, (row, row + 1))
                        wanted, hot = asked[row][::2], asked[row][1::2]
                        where = np.searchsorted(wanted, places[a:b])
                        hit = np.flatnonzero(np.append(wanted, -1)[where] == places[a:b])
                        for i, single in zip((a + hit).tolist(), hot[where[hit]].tolist()):
                            anchor, first, last = int(s.anchor[i]), int(s.first[i]), int(s.last[i])
                            place = int(places[i])
                            if not single:
                                gram = int(s.gram[i]).to_bytes(8, "big")
                                size += take(data, first, last, anchor, gram, (keys[row], place), several[row])
                                continue
                            for start in range(first, last + 1):
                                digest = hashlib.blake2b(data[start : start + window], digest_size=8).digest()
                                owner = (keys[row], place - anchor + start)
                                size += take(data, start, start, start, digest, owner, several[row])
                        if size >= run_bytes:
                            yield flush()
                            size = 0
        if strings or found.of:
            yield flush()

    return sort


def _merger(window: int, last: bool) -> Callable:
    """Merges the runs of a range; the last merge tells the repeated windows."""

    def merge_runs(table: pa.Table) -> pa.Table:
        found = _Found()
        release = lambda entry: found.release(entry, window)
        runs = [decode_run(data) for data in table["entries"].to_pylist()]
        merged = collapse(merge(runs), release)
        if not last:
            entries = [(key, before, owner) for _, key, before, owner in merged]
            number = table["range"][0].as_py()
            rows = [(number, uuid.uuid4().int >> 65, encode_run(entries), None, None)]
            return pa.Table.from_batches([_rows(rows + found.rows())])
        group: list[tuple] = []

        def settle() -> None:
            if len(group) < 2:
                return
            for (*_, owner), mask in zip(group, repeated_windows(group, window)):
                if owner is not None:
                    for low, high in _spans_of(mask):
                        found.add(owner[0], owner[1] - high, owner[1] - low)

        for entry in merged:
            if group and entry[0] < 8 + GRAM:
                settle()
                group = []
            group.append(entry)
        settle()
        return pa.Table.from_batches([_rows(found.rows())])

    return merge_runs


def _cutter(window: int) -> Callable:
    """What each text loses and keeps."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                buffer, offsets = bytes_of(column(batch, "text"))
                rows = []
                for row, (copies, found) in enumerate(
                    zip(column(batch, "copies").to_pylist(), column(batch, "found").to_pylist())
                ):
                    text = buffer[offsets[row] : offsets[row + 1]]
                    spans = np.frombuffer(b"".join(found or ()), np.int64).reshape(-1, 2)
                    if copies > 1:
                        spans = np.array([[0, len(text) - window]])[: len(text) >= window]
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, spans[:, 0], 1)
                    np.add.at(edge, spans[:, 1] + window, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    kept = hashlib.sha256(text[~gone].tobytes()).hexdigest()
                    runs = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[:1].sum())
                    rows.append((len(text), int(gone.sum()), runs, kept))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "key"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3])],
                    names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    return cut


def bucketed(df: DataFrame, by: str, name: str) -> DataFrame:
    """The rows stored in buckets of a column: joins by it exchange the other side only.

    There is one bucket per shuffle partition, so set these by the size of the texts.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"headway_{name}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(buckets, by).sortBy(by)
    writer.option("path", f"{shared_folder(spark)}/{table}").saveAsTable(table)
    return spark.table(table)


def removed_repeats(
    docs: DataFrame,
    window: int = 200,
    run_bytes: int = RUN_BYTES,
    range_bytes: int = RANGE_BYTES,
    fan_in: int = FAN_IN,
    hot: int = HOT,
) -> DataFrame:
    """Per document: bytes, bytes and runs that go, digest of what is kept."""
    content = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    texts = docs.select(content.alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    texts = bucketed(
        texts.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text")), "key", "texts"
    )
    anchors = stored(
        texts.filter(F.octet_length("text") >= window).select("key", "text").mapInArrow(_asker(window), ANSWER),
        "anchors",
    )
    # stored, so that the join is one of two plain exchanges, which are split where a gram is hot
    counts = stored(anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1), "grams")
    shared = anchors.join(counts, "gram").select(
        "key", F.struct("at", (F.col("n") > hot).cast("long").alias("hot")).alias("place")
    )
    asked = stored(shared.groupBy("key").agg(F.sort_array(F.collect_list("place")).alias("asked")), "asked")
    # strings of about two windows; of a hot gram, one of a window for each of some 85 windows
    weight = F.size("asked") * 2 + F.size(F.filter("asked", lambda p: p["hot"] == 1)) * 85
    amount = asked.agg(F.sum(weight)).first()[0] or 0
    ranges = max(1, -(-amount * window // range_bytes))
    joined = texts.join(asked, "key").select(
        "key", "copies", "text", F.flatten(F.transform("asked", lambda p: F.array(p["at"], p["hot"]))).alias("asked")
    )
    runs = stored(joined.mapInArrow(_sorter(window, ranges, run_bytes), RUNS), "runs")
    found = [runs.filter(F.col("key").isNotNull())]
    entries = runs.filter(F.col("key").isNull())
    while True:
        most = entries.groupBy("range").count().agg(F.max("count")).first()[0] or 0
        if most <= fan_in:
            break
        groups = -(-most // fan_in)
        by = entries.withColumn("_group", F.pmod("run", F.lit(groups)))
        part = stored(by.groupBy("range", "_group").applyInArrow(_merger(window, False), RUNS), "runs")
        found.append(part.filter(F.col("key").isNotNull()))
        entries = part.filter(F.col("key").isNull())
    found.append(entries.groupBy("range").applyInArrow(_merger(window, True), RUNS))
    spans = found[0]
    for other in found[1:]:
        spans = spans.unionByName(other)
    spans = spans.groupBy("key").agg(F.collect_list("found").alias("found"))
    result = texts.join(spans, "key", "left").mapInArrow(
        _cutter(window), "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    return docs.select("doc_id", content.alias("key")).join(result, "key").drop("key")
