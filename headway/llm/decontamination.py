"""Benchmark passages in documents, by SimHash fingerprints of item-sized windows.

For every item length, windows of that many words slide over the text, one word at a time,
wherever the text holds a shingle of an item of that length (a window without one has
similarity 0); a text shorter than the item is one window. A window's 64-bit SimHash comes
from running sums of its shingles' votes. A multi-index over blocks of the items'
fingerprints finds all items within the Hamming radius: by the pigeonhole principle one of
the blocks is within radius / blocks. What is found is verified by exact weighted similarity
of the shingle counts.

The items are the stated query set: they are held in blocks of bounded size, and the
documents are scanned once per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from headway.llm.common import U64, column, mixed, slices, window_hashes, words_of

RADIUS = 24
BLOCKS = 8
BLOCK_BYTES = 32 << 20  # text of the items that one pass over the documents compares
THRESHOLD = 0.8
WORDS = 5


def votes(hashes: np.ndarray) -> np.ndarray:
    """+1 / -1 per bit of each hash."""
    bits = np.unpackbits(mixed(hashes).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int16) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """64-bit SimHash of summed votes, as 8 bytes; a tie counts as 0."""
    return np.packbits(sums > 0, axis=1)


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _ONES[a ^ b].sum(axis=-1)


class MultiIndex:
    """All fingerprints within a radius: by block, every value within radius // blocks of the
    query's block leads to its members, whose full distance is then taken."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        near = radius // BLOCKS
        self.members = []
        every = np.arange(256)
        for block in range(BLOCKS):
            gap = _ONES[every[:, None] ^ prints[:, block][None, :]] <= near
            self.members.append([np.flatnonzero(row) for row in gap])

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, member) within the radius, once each."""
        found = []
        for block in range(BLOCKS):
            values = queries[:, block]
            for value in np.unique(values):
                own = np.flatnonzero(values == value)
                members = self.members[block][value]
                step = max(1, (1 << 20) // max(1, len(members)))
                for a in range(0, len(own), step):
                    part = own[a : a + step]
                    gap = distance(queries[part][:, None, :], self.prints[members][None, :, :])
                    q, m = np.nonzero(gap <= self.radius)
                    found.append(part[q] * len(self.prints) + members[m])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.prints), pairs % len(self.prints)


@dataclass
class Items:
    """One block of items, by length in words."""

    ids: list
    lengths: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray]]  # distinct shingles and their counts
    known: np.ndarray  # all shingles, sorted
    owners: list[np.ndarray]  # lengths (indexes of by_length) per known shingle
    by_length: list[tuple[int, int, np.ndarray, MultiIndex]]  # words, shingle width, items, index


def prepared(rows: list[tuple[int, str]], radius: int = RADIUS) -> Items:
    """Items of fewer than five words are compared as one shingle; items without words match
    nothing."""
    words = words_of(pa.array([t or "" for _, t in rows], pa.string()))
    lengths = np.diff(words.first)
    grams, prints, width = [], np.zeros((len(rows), 8), np.uint8), np.minimum(lengths, WORDS)
    for i in range(len(rows)):
        own = words.hashes[words.first[i] : words.first[i + 1]]
        if not len(own):
            grams.append((np.zeros(0, U64), np.zeros(0, np.int64)))
            continue
        h, _ = window_hashes(own, np.array([0, len(own)]), int(width[i]))
        grams.append(np.unique(h, return_counts=True))
        prints[i] = fingerprints(votes(h).sum(axis=0, dtype=np.int64)[None, :])[0]
    by_length = []
    for n in np.unique(lengths[lengths > 0]):
        own = np.flatnonzero(lengths == n)
        by_length.append((int(n), int(min(n, WORDS)), own, MultiIndex(prints[own], radius)))
    pairs: dict[int, set] = {}
    for k, (_, _, own, _) in enumerate(by_length):
        for i in own:
            for h in grams[i][0].tolist():
                pairs.setdefault(h, set()).add(k)
    known = np.array(sorted(pairs), U64)
    owners = [np.array(sorted(pairs[h])) for h in known.tolist()]
    return Items([r[0] for r in rows], lengths, grams, known, owners, by_length)


def _spread(places: np.ndarray, low: int, high: int, n: int) -> np.ndarray:
    """Starts of windows of n units within [low, high) that cover one of the places."""
    if high - low < n:
        return np.zeros(0, np.int64)
    first = np.maximum(places - n + 1, low)
    last = np.minimum(places, high - n)
    mark = np.zeros(high - low + 2, np.int32)
    np.add.at(mark, first - low, 1)
    np.add.at(mark, np.maximum(last, first - 1) - low + 1, -1)
    return np.flatnonzero(np.cumsum(mark)[: high - low] > 0) + low


def _windows_of(h: np.ndarray, places: np.ndarray, units: int, index: MultiIndex):
    """(window start, index of item) within the radius; h are shingles of one text."""
    starts = _spread(places, 0, len(h), units)
    if not len(starts):
        return
    # runs of starts close to each other share their running sums
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(starts) > units) + 1, [len(starts)]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        for c in range(int(a), int(b), 4096):
            own = starts[c : min(b, c + 4096)]
            low, high = int(own[0]), int(own[-1]) + units
            sums = np.zeros((high - low + 1, 64), np.int32)
            np.cumsum(votes(h[low:high]), axis=0, out=sums[1:])
            prints = fingerprints(sums[own - low + units] - sums[own - low])
            q, m = index.search(prints)
            for x, y in zip(own[q].tolist(), m.tolist()):
                yield x, y


def similarity(h: np.ndarray, gram: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of shingle counts: sum of minima by sum of maxima."""
    own, count = np.unique(h, return_counts=True)
    _, i, j = np.intersect1d(own, gram[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(count[i], gram[1][j]).sum())
    return both / (len(h) + int(gram[1].sum()) - both)


def matches(texts: pa.Array, items: Items, threshold: float) -> list[tuple]:
    """(row, item, start word, words, similarity) of the best window per text and item."""
    out: list[tuple] = []
    words = words_of(texts)
    for width in sorted({w for _, w, _, _ in items.by_length}):
        hashes, at = window_hashes(words.hashes, words.first, width)
        spot = np.searchsorted(items.known, hashes)
        spot[spot == len(items.known)] = 0
        hit = np.flatnonzero(items.known[spot] == hashes)
        if not len(hit):
            continue
        bounds = np.searchsorted(at, words.first)
        rows = np.searchsorted(bounds, hit, side="right") - 1
        edges = np.concatenate(([0], np.flatnonzero(np.diff(rows)) + 1, [len(rows)]))
        for a, b in zip(edges[:-1], edges[1:]):
            row, own = int(rows[a]), hit[a:b]
            low, high = int(bounds[row]), int(bounds[row + 1])
            h = hashes[low:high]
            lengths: dict[int, list[int]] = {}
            for p in own:
                for k in items.owners[spot[p]]:
                    lengths.setdefault(int(k), []).append(int(p) - low)
            best: dict[int, tuple] = {}
            for k, places in lengths.items():
                n, w, members, index = items.by_length[k]
                if w != width:
                    continue
                units = min(n - w + 1, len(h))  # a text shorter than the item is one window
                if units / (n - w + 1) < threshold:
                    continue  # the most that so few shingles can reach
                for start, m in _windows_of(h, np.array(places), units, index):
                    item = int(members[m])
                    s = similarity(h[start : start + units], items.grams[item])
                    if s >= threshold and (item not in best or s > best[item][2]):
                        best[item] = (start, units + w - 1, s)
            out += [(row, items.ids[i], start, n, s) for i, (start, n, s) in best.items()]
    return out


def contaminations(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD,
    radius: int = RADIUS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs`` and item it holds: ``key``, item_id, start_word (from 0),
    n_words and similarity of its best window (the first of equal ones).

    Null or empty texts and items hold nothing; a text shorter than an item is compared as a
    whole, n_words being its own.
    Repeated rows, of documents or items, give repeated rows; a null key stays null. Other
    columns are not read.
    """
    rows = docs.selectExpr(f"`{key}` as key", "cast(text as string) as text")
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, item_id long, start_word long, n_words long, similarity double"
    spark, found = docs.sparkSession, None
    for block in _blocks(items, block_bytes):
        shared = spark.sparkContext.broadcast(prepared(block, radius))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    own = matches(column(part, "text"), shared.value, threshold)
                    columns = list(zip(*own)) if own else [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [
                            column(part, "key").take(pa.array(columns[0], pa.int64())),
                            *[pa.array(c, pa.int64()) for c in columns[1:4]],
                            pa.array(columns[4], pa.float64()),
                        ],
                        names=["key", "item_id", "start_word", "n_words", "similarity"],
                    )

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    return found.withColumnRenamed("key", key)


def without_benchmark(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` whose text holds no item; all columns stay, nothing is shuffled."""
    spark = docs.sparkSession
    for block in _blocks(items, block_bytes):
        shared = spark.sparkContext.broadcast(prepared(block, radius))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    keep = np.ones(part.num_rows, bool)
                    keep[[m[0] for m in matches(column(part, "text"), shared.value, threshold)]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """The stated items in blocks of at most ``limit`` bytes of text, fetched as they come."""
    block, held = [], 0
    for r in items.selectExpr("cast(item_id as bigint) as item_id", "text").filter("text is not null").toLocalIterator():
        size = len(r["text"].encode())
        if block and held + size > limit:
            yield block
            block, held = [], 0
        block.append((r["item_id"], r["text"]))
        held += size
    if block:
        yield block
