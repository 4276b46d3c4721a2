"""Language identification by prediction by partial matching over bytes.

Per language a tree of contexts of up to ``ORDER`` bytes is counted from labelled text, with A-Z in
lower case and blanks alike, and then frozen. A context stands in the tree if it was seen ``LEAST``
times, so contexts are as long as the sample bears. The code of a byte starts in the longest
context of the tree that precedes it: a successor that was seen there costs its count, any
other the escape (method C: it weighs as much as there are distinct successors) and then its
code in the next shorter context, from which what was seen in the longer one is excluded.

The contexts of all trees are the states of one automaton: a state has a successor per byte and,
per language, the frozen code lengths of all bytes. The state before a byte follows from the
``ORDER`` bytes before it, so whole texts are coded exactly by a few table lookups per byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import LOWER, bytes_of, column, slices, stored

ORDER = 4
LEAST = 16  # times that a context must have been seen to be in the tree
TRAIN_CHARS = 400_000  # characters per language, the bound on the fitted sample
TRAIN_ROWS = 600  # rows per language
TRAIN_TEXT = 1 << 14  # characters of one training text
STRETCHES = 16  # a longer text gives so many stretches, one of each of its equal parts
MOST_LANGUAGES = 256  # languages that are learned, the most frequent values
UNKNOWN = "und"
BLANKS = (9, 10, 11, 12, 13, 32)


@dataclass
class Model:
    """States of the context trees. Class 0 are blanks, the last class bytes not seen."""

    languages: list[str]
    symbol: np.ndarray  # class of each byte
    share: np.ndarray  # bits that tell the byte within its class
    following: np.ndarray  # state behind a state and a class
    costs: np.ndarray  # bits of a class in a state, per language
    pooled: np.ndarray  # bits of a class without context, in all languages together
    order: int

    def bits(self, texts: pa.Array) -> np.ndarray:
        """Exact code length of each text under each language, in bits; the last column is the
        code length without context in all languages together."""
        buffer, offsets = bytes_of(texts)
        total = np.zeros((len(texts), len(self.languages) + 1))
        size, step = len(self.share), 1 << 19
        for a in range(0, len(buffer), step):
            low = max(0, a - self.order)
            sym = self.symbol[LOWER[buffer[low : a + step]]].astype(np.int32)
            place = np.arange(low, low + len(sym))
            row = np.searchsorted(offsets, place, side="right") - 1
            head = place - offsets[row]  # bytes before this one in its text
            state = np.zeros(len(sym), np.int32)
            for back in range(self.order, 0, -1):
                seen = np.zeros(len(sym), np.int32)
                seen[back:] = sym[:-back]
                seen[head < back] = 0  # a text begins behind blanks
                state = self.following[state * size + seen]
            sym, rows = sym[a - low :], row[a - low :]
            cost = self.costs[state[a - low :] * size + sym]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(rows)) + 1))
            share = np.add.reduceat(self.share[sym], cuts)
            total[rows[cuts], :-1] += np.add.reduceat(cost, cuts, axis=0, dtype=np.float64) + share[:, None]
            total[rows[cuts], -1] += np.add.reduceat(self.pooled[sym], cuts) + share
        return total


def _contexts(sym: np.ndarray, k: int, size: int) -> np.ndarray:
    """For every place the code of the k classes before it, blanks before the first."""
    code = np.zeros(len(sym), np.int64)
    padded = np.concatenate((np.zeros(k, np.int64), sym))
    for j in range(k):
        code = code * size + padded[j : j + len(sym)]
    return code


def _row(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities of all classes in contexts with these counts (one row each), given those in
    the next shorter contexts. Rows sum to one."""
    n = counts.sum(axis=1, keepdims=True)
    seen = counts > 0
    distinct = seen.sum(axis=1, keepdims=True)
    left = np.where(seen, 0, lower)
    rest = left.sum(axis=1, keepdims=True)
    # where nothing is left to escape to, the counts have it all
    escape = np.where(rest > 1e-9, distinct, 0)
    return counts / (n + escape) + left * (escape / (n + escape)) / np.where(rest > 1e-9, rest, 1)


def fit(
    texts: dict[str, list[str]], order: int = ORDER, least: int = LEAST
) -> Model:
    """Counts one context tree per language and joins them. Languages sort by name."""
    languages = sorted(g for g in texts if any(texts[g]))
    joined = {g: LOWER[np.frombuffer(("\n".join(texts[g])).encode(), np.uint8)] for g in languages}
    seen = np.zeros(256, bool)
    for b in joined.values():
        seen[np.unique(b)] = True
    seen[list(BLANKS)] = False
    symbol = np.zeros(256, np.int32)
    symbol[seen] = np.arange(1, seen.sum() + 1)
    size = int(seen.sum()) + 2
    other = ~seen
    other[list(BLANKS)] = False
    symbol[other] = size - 1
    share = np.zeros(size)
    share[0], share[-1] = np.log2(len(BLANKS)), np.log2(max(1, other.sum()))
    if not languages:
        none = np.zeros((size, 0), np.float32)
        return Model([], symbol, share, np.zeros(size, np.int32), none, np.full(size, np.log2(size)), order)
    syms = [symbol[joined[g]].astype(np.int64) for g in languages]

    # per order the states, by their code; a state's suffix is one of the order below
    codes, parents, rows = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], []
    base = np.full((1, size), 1 / size)
    for k in range(order + 1):
        kept = []
        tables = []
        for sym in syms:
            context = _contexts(sym, k, size)
            found, index, n = np.unique(context, return_inverse=True, return_counts=True)
            often = n >= (least if k else 0)
            kept.append(found[often])
            place = np.cumsum(often) - 1
            chosen = often[index]
            flat = np.bincount(
                place[index[chosen]] * size + sym[chosen], minlength=int(often.sum()) * size
            )
            tables.append(flat.reshape(-1, size))
        if k:
            codes.append(np.unique(np.concatenate(kept)))
            parents.append(np.searchsorted(codes[k - 1], codes[k] % size ** (k - 1)))
        level = np.empty((len(codes[k]), size, len(languages)), np.float64)
        for g, (own, counts) in enumerate(zip(kept, tables)):
            lower = rows[k - 1][parents[k], :, g] if k else base
            level[:, :, g] = lower  # a context that this language lacks is its shorter one
            at = np.searchsorted(codes[k], own)
            level[at, :, g] = _row(counts, lower[at])
        rows.append(level)
    first = np.cumsum([0, *map(len, codes)])
    following = []
    for k in range(order + 1):
        # the longest known suffix of the state and a further class
        behind = following[k - 1][parents[k]] if k else np.zeros((1, size), np.int64)
        if k < order and len(codes[k + 1]):
            longer = codes[k][:, None] * size + np.arange(size)[None, :]
            at = np.minimum(np.searchsorted(codes[k + 1], longer), len(codes[k + 1]) - 1)
            behind = np.where(codes[k + 1][at] == longer, first[k + 1] + at, behind)
        following.append(behind)
    costs = -np.log2(np.maximum(np.concatenate(rows), 1e-12)).astype(np.float32)
    everything = np.bincount(np.concatenate(syms), minlength=size)[None, :]
    pooled = -np.log2(np.maximum(_row(everything, base)[0], 1e-12))
    return Model(
        languages, symbol, share, np.concatenate(following).astype(np.int32).reshape(-1),
        costs.reshape(-1, len(languages)), pooled, order,
    )


def training_sample(docs: DataFrame, where: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` different texts per language, spread by hash: a bounded sample for fit()."""
    known = docs.filter(where & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("lang", F.xxhash64("text").alias("_chance"), "text")
    counts = known.groupBy("lang").agg(F.approx_count_distinct("_chance").alias("_texts"))
    counts = stored(counts.orderBy(F.desc("_texts"), "lang").limit(MOST_LANGUAGES), "languages")
    # about four times the wanted hashes of each language are ranked, whatever its size
    share = F.least(F.lit(1.0), F.lit(4.0 * rows) / F.col("_texts"))
    near = known.select("lang", "_chance").join(counts, "lang").filter(
        F.col("_chance").cast("double") / 2.0**64 + 0.5 <= share
    )
    order = Window.partitionBy("lang").orderBy("_chance")
    chosen = near.select("lang", "_chance").distinct().withColumn("_n", F.row_number().over(order))
    chosen = stored(chosen.filter(F.col("_n") <= rows).drop("_n"), "chosen")
    found = known.join(chosen, ["lang", "_chance"])
    once = found.select("lang", "_chance", _stretches().alias("text")).dropDuplicates(["lang", "_chance"])
    return once.orderBy("lang", "_chance").drop("_chance")


def _stretches() -> Column:
    """The text, or of one longer than TRAIN_TEXT characters as many from all over it."""
    length = TRAIN_TEXT // STRETCHES
    part = F.floor(F.length("text") / STRETCHES)

    def stretch(i: Column) -> Column:
        start = i * part + F.pmod(F.xxhash64("_chance", i), part - length + 1) + 1
        return F.substring("text", start.cast("int"), F.lit(length))

    places = F.sequence(F.lit(0), F.lit(STRETCHES - 1))
    return F.when(F.length("text") <= TRAIN_TEXT, F.col("text")).otherwise(
        F.array_join(F.transform(places, stretch), "")
    )


def trained(docs: DataFrame, where: Column, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS,
            order: int = ORDER) -> Model:
    """Fits on the sample; ``chars`` bounds what is used per language (in hash order)."""
    texts: dict[str, list[str]] = {}
    used: dict[str, int] = {}
    for r in training_sample(docs, where, rows).collect():  # ``rows`` texts of MOST_LANGUAGES at most
        if used.get(r["lang"], 0) < chars:
            texts.setdefault(r["lang"], []).append(r["text"])
            used[r["lang"]] = used.get(r["lang"], 0) + len(r["text"])
    return fit(texts, order)


LETTERS = r"\p{L}"


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1) to every row; whole texts are coded.

    The score is the share of the code length without context that the best language saves: 0 for
    a text that no language predicts better than frequencies of bytes do. A null text, or one without a letter, is ``und`` with score 0, as is
    every row if the model knows no language. Ties go to the language first by name. Columns
    of these names in ``docs`` are replaced.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*keep).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.coalesce(F.col(text).rlike(LETTERS), F.lit(False)).alias("_letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch, text):
                letters = column(part, "_letters").to_numpy(zero_copy_only=False)
                if known.languages:
                    bits = known.bits(column(part, text))
                    best = bits[:, :-1].argmin(axis=1)
                    least = bits[np.arange(len(bits)), best]
                    score = np.clip(1 - least / np.maximum(bits[:, -1], 1e-9), 0, 1)
                else:
                    best, score = np.zeros(len(letters), int), np.zeros(len(letters))
                    letters = np.zeros(len(letters), bool)
                names = np.array([*known.languages, UNKNOWN], object)
                best = np.where(letters, best, len(names) - 1)
                score = np.where(letters, score, 0.0)
                columns = [column(part, c) for c in keep]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(names[best], pa.string()), pa.array(score, pa.float64())],
                    names=[*keep, "lang_pred", "score"],
                )

    full = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return rows.mapInArrow(run, f"{full}, lang_pred string, score double")
