"""Vector bin packing of training examples into fixed-length sequences.

An example is a vector (tokens, segments, loss-bearing tokens). The dot-product heuristic
puts an example into the open sequence whose remaining room, weighted by the limits, points
most in the example's direction, so that many short examples do not use up the segments of
a sequence while its tokens stay free. Each task packs its own rows as they stream by: no
shuffle, memory bounded by the open sequences and one batch.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from headway.llm.common import column, slices

CAPACITY = 2048
SEGMENTS = 1024
OPEN = 64  # open sequences per task; the fullest one is closed beyond that
END_ID = 1


@dataclass
class Sequence:
    room: np.ndarray
    pieces: list = field(default_factory=list)


class Packer:
    """Places (vector, payload) pairs; ``limits`` and vectors have one entry per dimension.

    Ties go to the sequence opened first. A vector above a limit raises ValueError.
    """

    def __init__(self, limits: tuple[int, ...], open_limit: int = OPEN):
        self.limits = np.array(limits, float)
        self.open_limit = open_limit
        self.rooms = np.zeros((0, len(limits)))
        self.open: list[list] = []

    def place(self, vector, payload) -> list:
        """Puts the example somewhere; returns sequences closed by that."""
        vector = np.array(vector, float)
        if (vector > self.limits).any():
            raise ValueError(f"an example of {vector} does not fit into {self.limits}")
        fits = (self.rooms >= vector).all(axis=1) if len(self.open) else np.zeros(0, bool)
        closed = []
        if fits.any():
            scaled = self.rooms / self.limits
            # direction of the room against that of the example: a good fit leaves no odd rest
            score = (scaled @ (vector / self.limits)) / np.maximum((scaled * scaled).sum(axis=1), 1e-12)
            score[~fits] = -np.inf
            at = int(np.argmax(score))
        else:
            if len(self.open) >= self.open_limit:
                closed.append(self._close(int(np.argmin(self.rooms[:, 0]))))
            self.open.append([])
            self.rooms = np.vstack((self.rooms, self.limits))
            at = len(self.open) - 1
        self.rooms[at] -= vector
        self.open[at].append(payload)
        if self.rooms[at, 0] == 0:
            closed.append(self._close(at))
        return closed

    def fits(self, vector) -> bool:
        return bool(len(self.open)) and bool((self.rooms >= vector).all(axis=1).any())

    def gap(self) -> tuple[int, int] | None:
        """The fullest open sequence that takes one more segment, and the ids it takes; None
        while new sequences can be opened."""
        if len(self.open) < self.open_limit:
            return None
        takes = np.minimum(self.rooms[:, 0], self.rooms[:, 2])
        takes[self.rooms[:, 1] < 1] = 0
        usable = np.flatnonzero(takes > 0)
        if not len(usable):
            return None
        at = int(usable[np.argmin(takes[usable])])
        return at, int(takes[at])

    def fill(self, at: int, payload) -> list:
        """Ends a sequence with a piece cut to its gap."""
        self.open[at].append(payload)
        return self._close(at)

    def _close(self, at: int) -> list:
        done = self.open.pop(at)
        self.rooms = np.delete(self.rooms, at, axis=0)
        return done

    def drain(self) -> list:
        rest, self.open = self.open, []
        self.rooms = self.rooms[:0]
        return rest


def pack_examples(
    examples: DataFrame, key: str, tokens: str, segments: str, loss: str,
    limits: tuple[int, int, int], open_limit: int = OPEN,
) -> DataFrame:
    """Places whole examples: columns ``key``, sequence_id, offset, tokens, segments, loss.

    Null sizes count as 0. An example above a limit cannot be placed and gets a null
    sequence_id. Rows that repeat are packed as often as they occur; other columns are not
    read, so their names cannot clash. No rows in, no rows out.
    """
    kind = examples.schema[key].dataType.simpleString()
    rows = examples.selectExpr(
        f"`{key}` as key",
        *[f"coalesce(cast(`{c}` as bigint), 0) as {n}" for c, n in ((tokens, "tokens"), (segments, "segments"), (loss, "loss"))],
    )

    def run(batches):
        packer, number = Packer(limits, open_limit), _first_number()
        out: list[tuple] = []

        def emit(done):
            nonlocal number
            at = 0
            for key_, v in done:
                out.append((key_, number, at, *map(int, v)))
                at += int(v[0])
            number += 1

        for batch in batches:
            vectors = np.column_stack([column(batch, c).to_numpy() for c in ("tokens", "segments", "loss")])
            keys = column(batch, "key").to_pylist()
            # longest side first within a batch
            for i in np.argsort(-(vectors / np.array(limits)).max(axis=1), kind="stable"):
                if (vectors[i] > limits).any():
                    out.append((keys[i], None, None, *map(int, vectors[i])))
                    continue
                for done in packer.place(vectors[i], (keys[i], vectors[i])):
                    emit(done)
            yield _table(out, batch.schema.field("key").type)
            out = []
        for done in packer.drain():
            emit(done)
        if out:
            yield _table(out, batch.schema.field("key").type)

    return rows.mapInArrow(
        run, f"`key` {kind}, sequence_id long, offset long, tokens long, segments long, loss long"
    ).withColumnRenamed("key", key)


def _table(rows: list[tuple], key_type) -> pa.RecordBatch:
    names = ["key", "sequence_id", "offset", "tokens", "segments", "loss"]
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    kinds = [key_type] + [pa.int64()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _first_number() -> int:
    """Sequence numbers of a task: its partition in the upper bits."""
    return TaskContext.get().partitionId() << 33


_ENCODINGS: dict[str, object] = {}


def encoder(path: str):
    """ids of a text by a byte-level BPE rank file ("<id> per line", read once a worker).

    The ranks and the splitting pattern are those of the JSON tokenizer file of the same
    name, so the ids are equal; tests compare them.
    """
    if path not in _ENCODINGS:
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = {"<|endoftext|>": len(ranks)}  # as in the JSON file
        _ENCODINGS[path] = tiktoken.Encoding(
            "public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
    return _ENCODINGS[path]


def encoded(text: str, path: str) -> np.ndarray:
    coding = encoder(path)
    if "<|endoftext|>" in text:
        return np.array(coding.encode(text, allowed_special="all"), np.uint32)
    return np.array(coding.encode_to_numpy(text, allowed_special=set(), disallowed_special=()), np.uint32)


PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long, sequence_tokens long"
)


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, segments: int = SEGMENTS,
    loss: int | None = None, end_id: int = END_ID, open_limit: int = OPEN,
) -> DataFrame:
    """Cuts tokenised documents into pieces and packs them: one row per piece.

    Whole stretches of ``capacity`` ids are sequences of their own; the rests are placed by
    the dot-product heuristic under the limits on tokens, segments and loss-bearing tokens
    (all but the end mark). What a task has open at its end is filled up by cutting, and the
    last ids are cut into powers of two, which need no padding.

    A null text is empty and has the end mark only. Equal rows are packed as often as they
    occur, a null doc_id stays null, and only doc_id and text are read. No rows: no pieces.
    """
    loss = capacity if loss is None else loss
    limits = (capacity, segments, loss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, packer = _first_number(), Packer(limits, open_limit)
        out: list[tuple] = []

        def emit(pieces) -> None:
            nonlocal number
            at, total = 0, sum(len(p[2]) for p in pieces)
            for doc, start, ids, whole in pieces:
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                out.append((doc, start, len(ids), crc, whole, number, at, total))
                at += len(ids)
            number += 1

        def batch_of():
            nonlocal out
            columns = list(zip(*out)) if out else [[]] * 8
            out = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=PIECE_NAMES)

        for batch in batches:
            for part in slices(batch, "text"):
                rests = []
                for doc, text in zip(column(part, "doc_id").to_pylist(), column(part, "text").to_pylist()):
                    ids = np.append(encoded(text or "", path), np.uint32(end_id))
                    whole = len(ids)
                    stretch = min(capacity, loss)
                    full = whole // stretch * stretch
                    for a in range(0, full, stretch):
                        emit([(doc, a, ids[a : a + stretch], whole)])
                    if full < whole:
                        rests.append((doc, full, ids[full:], whole))
                rests.sort(key=lambda r: -len(r[2]))
                for doc, start, ids, whole in rests:
                    # no room as a whole: the head ends the fullest sequence, without padding
                    while not packer.fits((len(ids), 1, min(len(ids), loss))) and (gap := packer.gap()):
                        at, n = gap
                        if n >= len(ids):
                            break
                        emit(packer.fill(at, (doc, start, ids[:n], whole)))
                        start, ids = start + n, ids[n:]
                    rest, n = (doc, start, ids, whole), len(ids)
                    for done in packer.place((n, 1, min(n, loss)), rest):
                        emit(done)
                if out:
                    yield batch_of()
        for done in _filled(packer.drain(), capacity, segments, loss):
            emit(done)
        if out:
            yield batch_of()

    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(run, PIECE_SCHEMA)


PIECE_NAMES = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]


def _filled(left: list[list], capacity: int, segments: int, loss: int) -> Iterator[list]:
    """The open sequences once more, filled to the limit by cutting; the last one in powers of
    two, each shorter than the one before."""
    sizes = sorted(left, key=lambda pieces: -sum(len(p[2]) for p in pieces))
    queue = [p for pieces in sizes for p in pieces]
    queue.reverse()
    rest = sum(len(p[2]) for p in queue)
    most = min(capacity, loss)
    while queue:
        target = most if rest >= most else 1 << (rest.bit_length() - 1)
        taken, got = [], 0
        while got < target and len(taken) < segments:
            doc, start, ids, whole = queue.pop()
            n = min(len(ids), target - got)
            taken.append((doc, start, ids[:n], whole))
            got += n
            if n < len(ids):
                queue.append((doc, start + n, ids[n:], whole))
        rest -= got
        yield taken
