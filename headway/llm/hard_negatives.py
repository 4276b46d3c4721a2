"""Hard negatives by rotated one-bit codes with a stored code-vector alignment.

A vector v is turned by a fixed random rotation; its code keeps the signs b (as a unit vector),
and beside the code stand the norm |v| and the alignment c = <b, v/|v|>. With the rotated anchor q

    <v, q> = |v| (c <b, q> + <r, q>),  r orthogonal to b and |r|^2 = 1 - c^2,

so by Cauchy-Schwarz |<r, q>| <= sqrt(1 - c^2) sqrt(|q|^2 - <b, q>^2). <b, q> itself is
estimated by popcounts of the code with the bit planes of the rounded anchor, whose rounding error
is bounded the same way. The interval is certain, so rows outside of what can still count are
dropped without loss, and the others are scored as integers.

Anchors are the stated query set. They are numbered, and each block of at most ``BLOCK_BYTES`` of
them is compared with all rows in one scan; a task keeps its best few rows per anchor.

Rows without id or label, and rows whose vector is null or has a null or non-finite component,
take no part. A shorter vector counts as followed by zeros. Ties go to the smaller id, repeated rows
count as rows of their own (an anchor is not its own partner, nor is a row of the same id), and a
repeated anchor gives its rows once per repetition. An empty table gives no rows. Scores beyond
a long are set to its limits. Only the named columns are read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import column, numbered, stored

SCALE = 256
SEED = 13
PLANES = 6  # bits per component of an anchor
BLOCK_BYTES = 16 << 20  # vectors of the anchors that one scan compares
STEP = 4096  # rows per step of a task
EXACT = float(1 << 52)  # sums up to here are exact in doubles
LONG = (-(1 << 63), (1 << 63) - 1)

CODES = "id long, label long, anchor boolean, vector array<long>, code binary, norm double, alignment double"
POSITIVES = "anchor long, id long, score long"
NEGATIVES = "anchor long, positive int, id long, score long"


@functools.cache
def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    turned, upper = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return turned * np.sign(np.diag(upper))


def words_for(dim: int) -> int:
    """Dimensions of a code: whole 64-bit words."""
    return max(1, -(-dim // 64)) * 64


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code words, norms and alignments of vectors, one row each."""
    dim = words_for(vectors.shape[1])
    wide = np.zeros((len(vectors), dim))
    wide[:, : vectors.shape[1]] = vectors
    norms = np.sqrt(np.einsum("ij,ij->i", wide, wide))
    turned = wide @ rotation(dim).T
    signs = turned > 0
    size = np.where(norms > 0, norms, 1)
    alignment = np.abs(turned).sum(axis=1) / np.sqrt(dim) / size
    packed = np.packbits(signs, axis=1, bitorder="little").view(np.uint64)
    return packed, norms, np.minimum(alignment, 1)


class Anchor:
    """Bit planes of a rotated anchor; ``bounds`` gives certain intervals of inner products."""

    def __init__(self, vector: np.ndarray, dim: int):
        turned = rotation(dim)[:, : len(vector)] @ vector.astype(float)
        low, high = float(turned.min()), float(turned.max())
        self.step = (high - low) / ((1 << PLANES) - 1) or 1.0
        self.low = low
        levels = np.rint((turned - low) / self.step).astype(np.uint64)
        self.planes = [
            np.packbits((levels >> np.uint64(p)) & np.uint64(1) == 1, bitorder="little").view(np.uint64)
            for p in range(PLANES)
        ]
        rounded = low + self.step * levels.astype(float)
        self.total = float(rounded.sum())
        self.error = float(np.linalg.norm(turned - rounded)) + 1e-9
        self.square = float(vector.astype(float) @ vector.astype(float))
        self.root = np.sqrt(dim)

    def bounds(self, code: np.ndarray, norm: np.ndarray, alignment: np.ndarray):
        weighted = np.zeros(len(code), np.int64)
        count = np.zeros(len(code), np.int64)
        for p, plane in enumerate(self.planes):
            weighted += np.bitwise_count(code & plane).sum(axis=1, dtype=np.int64) << p
        count = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        along = (2 * (self.low * count + self.step * weighted) - self.total) / self.root
        across = np.sqrt(np.maximum(self.square - np.maximum(np.abs(along) - self.error, 0) ** 2, 0))
        rest = np.sqrt(np.maximum(1 - alignment**2, 0))
        width = norm * (alignment * self.error + rest * across)
        middle = norm * alignment * along
        slack = 1e-6 + 1e-9 * norm * np.sqrt(self.square)
        return middle - width - slack, middle + width + slack


def scores(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors, exact; beyond a long its limits."""
    if rows.dtype == object or vector.dtype == object:
        sums = rows.astype(object) @ vector.astype(object)
        return np.array([min(max(int(s), LONG[0]), LONG[1]) for s in sums], dtype=np.int64)
    a, b = rows.astype(float), vector.astype(float)
    if len(rows) and np.abs(a).sum(axis=1).max() * np.abs(b).max(initial=0) >= EXACT:
        return scores(rows.astype(object), vector.astype(object))
    return (a @ b).astype(np.int64)


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Integer vectors of at most dim components as rows, followed by zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _encoder(dim: int) -> Callable:
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch = whole.slice(at, STEP)
                vectors = _matrix(column(batch, "vector"), dim)
                code, norm, alignment = codes(vectors)
                yield pa.RecordBatch.from_arrays(
                    [column(batch, c) for c in ("id", "label", "anchor", "vector")]
                    + [pa.array([c.tobytes() for c in code], pa.binary()), pa.array(norm), pa.array(alignment)],
                    names=["id", "label", "anchor", "vector", "code", "norm", "alignment"],
                )

    return encode


def encoded(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows that take part as integers with their codes, stored, and the dimensions.

    ``rows`` has id, label, anchor and the vector.
    """
    x = F.col(vector).cast("array<double>")
    # comparisons with null are null, and NaN is above all numbers
    finite = F.forall(x, lambda v: F.coalesce((v < float("inf")) & (v > float("-inf")), F.lit(False)))
    whole = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = whole.select(
        "id", "label", "anchor", F.transform(x, lambda v: F.floor(v * SCALE).cast("long")).alias("vector")
    )
    dim = whole.agg(F.max(F.size("vector"))).first()[0] or 1
    return stored(whole.mapInArrow(_encoder(dim), CODES), "codes"), dim


def _steps(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[tuple]:
    for whole in batches:
        for at in range(0, whole.num_rows, STEP):
            batch = whole.slice(at, STEP)
            packed = np.frombuffer(b"".join(column(batch, "code").to_pylist()), np.uint64)
            yield (
                column(batch, "id").to_numpy(), column(batch, "label").to_numpy(),
                _matrix(column(batch, "vector"), dim), packed.reshape(batch.num_rows, -1),
                column(batch, "norm").to_numpy(), column(batch, "alignment").to_numpy(),
            )


class Best:
    """The first k rows by score, then by smaller id."""

    def __init__(self, k: int):
        self.k = k
        self.ids = np.zeros(0, np.int64)
        self.scores = np.zeros(0, np.int64)

    def least(self) -> int:
        """Rows below this score cannot come among the first."""
        return int(self.scores[-1]) if len(self.scores) == self.k else LONG[0]

    def add(self, ids: np.ndarray, values: np.ndarray) -> None:
        if len(ids):
            ids, values = np.concatenate((self.ids, ids)), np.concatenate((self.scores, values))
            first = np.lexsort((ids, ~values))[: self.k]
            self.ids, self.scores = ids[first], values[first]


def _positives(anchors: list[tuple], dim: int, k: int) -> Callable:
    """Per anchor (number, id, label, vector): the best rows of its label in a task."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = [(number, ident, label, np.array(vector), Anchor(np.array(vector), words_for(dim)), Best(k))
                 for number, ident, label, vector in anchors]
        for ids, labels, vectors, code, norm, alignment in _steps(batches, dim):
            # every anchor looks at the rows of its own label only
            by_label = {label: np.flatnonzero(labels == label) for label in np.unique(labels).tolist()}
            parts = {label: (ids[i], vectors[i], code[i], norm[i], alignment[i]) for label, i in by_label.items()}
            for _, ident, label, vector, anchor, best in plans:
                if label not in parts:
                    continue
                own_ids, own, *stored_code = parts[label]
                low, high = anchor.bounds(*stored_code)
                other = own_ids != ident
                least = float(best.least())
                if other.sum() >= k:
                    least = max(least, np.partition(low[other], -k)[-k])
                left = np.flatnonzero(other & (high >= least))
                best.add(own_ids[left], scores(own[left], vector))
        rows = [(number, i, s) for number, *_, best in plans for i, s in zip(best.ids.tolist(), best.scores.tolist())]
        yield _rows(rows, ("anchor", "id", "score"))

    return scan


def _negatives(anchors: list[tuple], dim: int, k: int, band: tuple[int, int]) -> Callable:
    """Per anchor (number, id, label, vector, scores of its positives): the best rows of
    other labels in the band of each positive."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = []
        for number, ident, label, vector, positives in anchors:
            bands = [(-(-band[0] * p // 100), band[1] * p // 100, Best(k), j) for j, p in positives]
            bands = [b for b in bands if b[0] <= b[1]]
            if bands:
                vector = np.array(vector)
                plans.append((number, ident, label, vector, Anchor(vector, words_for(dim)), bands))
        for ids, labels, vectors, code, norm, alignment in _steps(batches, dim):
            for _, ident, label, vector, anchor, bands in plans:
                low, high = anchor.bounds(code, norm, alignment)
                floor = min(max(b[0], b[2].least()) for b in bands)
                left = np.flatnonzero(
                    (labels != label) & (ids != ident) & (high >= floor) & (low <= max(b[1] for b in bands))
                )
                values = scores(vectors[left], vector)
                for least, most, best, _ in bands:
                    inside = (values >= max(least, best.least())) & (values <= most)
                    best.add(ids[left[inside]], values[inside])
        rows = [
            (number, j, i, s) for number, *_, bands in plans for *_, best, j in bands
            for i, s in zip(best.ids.tolist(), best.scores.tolist())
        ]
        yield _rows(rows, ("anchor", "positive", "id", "score"))

    return scan


def _rows(rows: list[tuple], names: tuple) -> pa.RecordBatch:
    types = [pa.int32() if n == "positive" else pa.int64() for n in names]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=list(names))


def _first(found: DataFrame, k: int, by: list[str], name: str) -> DataFrame:
    """The first k of each anchor over all tasks."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def mine(
    rows: DataFrame,
    anchors: Column,
    identity: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    n_positives: int = 5,
    n_negatives: int = 3,
    band: tuple[int, int] = (50, 95),
    block: int | None = None,
) -> DataFrame:
    """Per anchor and positive the first rows of other labels whose score lies within ``band``
    percent of the positive's."""
    label = F.col(label) if isinstance(label, str) else label
    named = rows.select(
        F.col(identity).cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col(vector),
    )
    table, dim = encoded(named, vector)
    queries = numbered(table.filter("anchor").select("id", "label", "vector"), ["id", "label", "vector"], "number")
    total = queries.count()
    block = block or max(64, BLOCK_BYTES // (8 * dim))
    spark = rows.sparkSession
    results = []
    for start in range(0, total, block):
        part = queries.filter((F.col("number") >= start) & (F.col("number") < start + block))
        held = [(r.number, r.id, r.label, list(r.vector) + [0] * (dim - len(r.vector))) for r in part.collect()]
        near = _first(table.mapInArrow(_positives(held, dim, n_positives), POSITIVES), n_positives, ["anchor"], "place")
        positives = stored(near, "positives")
        known: dict[int, list[tuple[int, int]]] = {}
        for r in positives.collect():  # at most n_positives per anchor of the block
            known.setdefault(r.anchor, []).append((r.place, r.score))
        asked = [(*a, known[a[0]]) for a in held if a[0] in known]
        found = table.mapInArrow(_negatives(asked, dim, n_negatives, band), NEGATIVES)
        first = _first(found, n_negatives, ["anchor", "positive"], "rank")
        names = spark.createDataFrame([(a[0], a[1]) for a in held], "anchor long, anchor_id long")
        results.append(
            first.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
            .join(
                positives.select(
                    "anchor", F.col("place").alias("positive"), F.col("id").alias("positive_id"),
                    F.col("score").alias("positive_score"),
                ),
                ["anchor", "positive"],
            )
            .join(names, "anchor")
        )
    wanted = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if not results:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    return functools.reduce(DataFrame.unionByName, results).select(*wanted)
