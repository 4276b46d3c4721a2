"""Personal data: exact patterns, and a linear-chain conditional random field beside them.

The field works on the shapes of tokens and of their neighbours, is trained from a small
labelled table, and is decoded by Viterbi for many stretches of text at once in numpy.
Tokens of words without a digit or an ``@`` can only be outside; a forced label cuts the
chain exactly, so only the stretches between such words are decoded, of whole texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import column, slices, words_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("outside", *KINDS)
SAMPLE = 600  # stretches the query labels for training; the bound of the labelled table
AROUND = 60  # characters kept on both sides of a stretch in the sample

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        if at >= done:
            start = at
            while start > done and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            found = _DOMAIN.match(text, at + 1) if start < at else None
            if found:
                out.append((start, found.end()))
                done = found.end()
        at = text.find("@", at + 1)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def exact_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points) by kind, then start; failing matches are dropped."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.DOTALL)


def tokens(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text) if not m.group().isspace()]


def shapes(text: str, spans: Sequence[tuple[int, int]]) -> list[str]:
    """Word shape of each token; a leading blank is part of it."""
    out, before = [], -1
    for a, b in spans:
        part = text[a:b]
        if part[0].isdigit():
            shape = f"d{min(b - a, 20)}"
        elif part[0].isalpha():
            case = "x" if part.islower() else "X" if part.isupper() else "Xx"
            shape = f"{case}{min(b - a, 4)}"
        else:
            shape = part
        out.append((" " if a != before else "") + shape)
        before = b
    return out


@dataclass
class Field:
    """Weights of the conditional random field: shapes of a token, of the one before and of
    the one behind, per label, and of label changes."""

    shape: dict[str, int]
    own: np.ndarray
    before: np.ndarray
    behind: np.ndarray
    change: np.ndarray

    def scores(self, rows: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Label scores of token sequences, padded, and their lengths."""
        width = max(map(len, rows)) if rows else 0
        ids = np.zeros((len(rows), width + 2), np.int64)
        for i, row in enumerate(rows):
            ids[i, 1 : len(row) + 1] = [self.shape.get(s, 0) for s in row]
        lengths = np.array([len(r) for r in rows], np.int64)
        return self.own[ids[:, 1:-1]] + self.before[ids[:, :-2]] + self.behind[ids[:, 2:]], lengths

    def decode(self, rows: Sequence[Sequence[str]]) -> list[np.ndarray]:
        """Best label sequences (Viterbi), for sequences of similar length together."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(rows)
        order = sorted((i for i in range(len(rows)) if rows[i]), key=lambda i: len(rows[i]))
        at = 0
        while at < len(order):
            longest = 2 * len(rows[order[at]])
            own = [i for i in order[at : at + 4096] if len(rows[i]) <= longest]
            at += len(own)
            score, lengths = self.scores([rows[i] for i in own])
            best = score[:, 0].copy()
            back = np.zeros(score.shape, np.int8)
            for t in range(1, score.shape[1]):
                step = best[:, :, None] + self.change
                back[:, t] = step.argmax(axis=1)
                grown = step.max(axis=1) + score[:, t]
                best = np.where((t < lengths)[:, None], grown, best)
            for k, i in enumerate(own):
                n = int(lengths[k])
                path = np.zeros(n, np.int64)
                path[-1] = best[k].argmax()
                for t in range(n - 1, 0, -1):
                    path[t - 1] = back[k, t, path[t]]
                out[i] = path
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(table: Sequence[tuple[str, Sequence[tuple[str, int, int]]]], rounds: int = 30,
          rate: float = 0.5, penalty: float = 1e-3) -> Field:
    """Fits by gradient ascent on the conditional likelihood of a labelled table of
    (text, spans). An empty table gives a field that labels nothing."""
    rows, gold = [], []
    for text, spans in table:
        marks = tokens(text)
        if not marks:
            continue
        labels = np.zeros(len(marks), np.int64)
        for kind, a, b in spans:
            for i, (x, y) in enumerate(marks):
                if x < b and y > a:
                    labels[i] = LABELS.index(kind)
        rows.append(shapes(text, marks))
        gold.append(labels)
    seen: dict[str, int] = {}
    for row in rows:
        for s in row:
            seen.setdefault(s, len(seen) + 1)
    n, k = len(seen) + 1, len(LABELS)
    field = Field(seen, *(np.zeros((n, k)) for _ in range(3)), np.zeros((k, k)))
    if not rows:
        field.own[:, 0] = 1.0
        return field
    width = max(map(len, rows))
    ids = np.zeros((len(rows), width + 2), np.int64)
    want = np.zeros((len(rows), width), np.int64)
    lengths = np.array([len(r) for r in rows])
    for i, row in enumerate(rows):
        ids[i, 1 : len(row) + 1] = [seen[s] for s in row]
        want[i, : len(row)] = gold[i]
    inside = np.arange(width)[None, :] < lengths[:, None]
    parts = [field.own, field.before, field.behind, field.change]
    squares = [np.full_like(p, 1e-6) for p in parts]
    for _ in range(rounds):
        score = field.own[ids[:, 1:-1]] + field.before[ids[:, :-2]] + field.behind[ids[:, 2:]]
        score[~inside] = 0
        alpha = np.zeros_like(score)
        beta = np.zeros_like(score)
        alpha[:, 0] = score[:, 0]
        for t in range(1, width):
            grown = _logsum(alpha[:, t - 1][:, :, None] + field.change, 1) + score[:, t]
            alpha[:, t] = np.where(inside[:, t][:, None], grown, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            grown = _logsum(field.change + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(inside[:, t + 1][:, None], grown, 0)
        total = _logsum(alpha[:, -1], 1)
        chance = np.exp(alpha + beta - total[:, None, None])
        delta = -chance
        np.put_along_axis(
            delta, want[:, :, None], np.take_along_axis(delta, want[:, :, None], 2) + 1, 2
        )
        delta[~inside] = 0
        grads = [np.zeros_like(p) for p in parts]
        flat = delta.reshape(-1, k)
        for g, shift in zip(grads[:3], (ids[:, 1:-1], ids[:, :-2], ids[:, 2:])):
            np.add.at(g, shift.reshape(-1), flat)
        for t in range(1, width):
            on = inside[:, t]
            if not on.any():
                break
            pair = alpha[on, t - 1][:, :, None] + field.change + (score[on, t] + beta[on, t])[:, None, :]
            grads[3] -= np.exp(pair - total[on][:, None, None]).sum(axis=0)
            np.add.at(grads[3], (want[on, t - 1], want[on, t]), 1)
        for p, g, s in zip(parts, grads, squares):
            g = g / len(rows) - penalty * p
            s += g * g
            p += rate * g / np.sqrt(s)
    return field


def labelled_sample(docs: DataFrame, rows: int = SAMPLE) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """A small labelled table from the corpus: at most ``rows`` stretches with a digit or an
    ``@``, chosen by hash, labelled by the exact patterns."""
    stretch = F.regexp_extract("text", rf"(?s).{{0,{AROUND}}}[0-9@].{{0,{AROUND}}}", 0)
    found = (
        docs.filter(F.col("text").rlike("[0-9@]"))
        .select(stretch.alias("text"))
        .withColumn("_chance", F.xxhash64("text"))
        .orderBy("_chance", "text")
        .limit(rows)
        .collect()
    )
    return [(r["text"], exact_spans(r["text"])) for r in found]


# Fewest digits of a kind; an added span with fewer, or an address without its sign, goes.
_DIGITS = {"email": 0, "ip": 4, "card": 12, "phone": 7}


def _plausible(kind: str, piece: str) -> bool:
    digits = sum(c.isdigit() for c in piece)
    return digits >= _DIGITS[kind] and ("@" in piece) == (kind == "email")


class Finder:
    """Spans of many texts: exact ones, and those the field adds beside them."""

    def __init__(self, field: Field):
        self.field = field

    def find(self, texts: pa.Array) -> list[tuple[list, list]]:
        """Per text (exact spans, all spans), each sorted by kind as listed, then start."""
        words = words_of(texts, lower=False)
        n = len(texts)
        out: list[tuple[list, list]] = [([], [])] * n
        marked = np.zeros(256, np.int64)
        marked[48:58] = 1
        marked[64] = 1
        sums = np.concatenate(([0], np.cumsum(marked[words.buffer])))
        hot = np.flatnonzero(sums[words.ends] > sums[words.starts])
        if not len(hot):
            return out
        owner = np.searchsorted(words.first, hot, side="right") - 1
        cut = np.flatnonzero((np.diff(hot) > 1) | (np.diff(owner) > 0)) + 1
        begins, ends = hot[np.concatenate(([0], cut))], hot[np.concatenate((cut - 1, [len(hot) - 1]))]
        row_of = np.searchsorted(words.first, begins, side="right") - 1
        heads = np.concatenate(([0], np.cumsum((words.buffer & 0xC0) != 0x80)))
        text, exact, stretches, owners = {}, {}, [], []
        for a, b, row in zip(begins, ends, row_of):
            row = int(row)
            if row not in text:
                text[row] = texts[row].as_py()
                exact[row] = exact_spans(text[row])
            base = heads[words.offsets[row]]
            at, to = int(heads[words.starts[a]] - base), int(heads[words.ends[b]] - base)
            part = text[row][at:to]
            marks = tokens(part)
            if marks:
                stretches.append((row, at, part, marks))
                owners.append(shapes(part, marks))
        added: dict[int, list] = {}
        for (row, at, part, marks), path in zip(stretches, self.field.decode(owners)):
            i = 0
            while i < len(path):
                j = i
                while j + 1 < len(path) and path[j + 1] == path[i]:
                    j += 1
                if path[i]:
                    a, b = at + marks[i][0], at + marks[j][1]
                    piece = text[row][a:b]
                    taken = any(x < b and y > a for _, x, y in exact[row])
                    if not taken and _plausible(LABELS[path[i]], piece):
                        added.setdefault(row, []).append((LABELS[path[i]], a, b))
                i = j + 1
        rank = {k: i for i, k in enumerate(KINDS)}
        for row, own in exact.items():
            every = sorted(own + added.get(row, []), key=lambda s: (rank[s[0]], s[1], s[2]))
            out[row] = (own, every)
        return out


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
            done = b
        else:
            done = max(done, b)
    return "".join(out) + text[done:]


def find_personal_data(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Adds to every row: n_email, n_ip, n_card, n_phone (exact ones), base (exact spans,
    ``kind:start:end`` joined), spans (all), masked (the text without them).

    A null text counts as empty and stays null in ``masked``; repeated rows stay. Columns of
    these names in ``docs`` are replaced, all others pass through.
    """
    added = [*[f"n_{k}" for k in KINDS], "base", "spans", "masked"]
    keep = [c for c in docs.columns if c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for batch in batches:
            for part in slices(batch, text):
                texts = column(part, text)
                found = finder.find(texts)
                counts = [
                    pa.array([sum(s[0] == k for s in own) for own, _ in found], pa.int64())
                    for k in KINDS
                ]
                clean = texts
                if any(every for _, every in found):
                    clean = pa.array(
                        [masked(t, every) if every else t
                         for t, (_, every) in zip(texts.to_pylist(), found)], pa.string()
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        *[column(part, c) for c in keep], *counts,
                        pa.array([joined(own) for own, _ in found], pa.string()),
                        pa.array([joined(every) for _, every in found], pa.string()),
                        clean,
                    ],
                    names=[*keep, *added],
                )

    full = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(*keep).mapInArrow(run, f"{full}, {counts}, base string, spans string, masked string")


def digest(base: str) -> str:
    return hashlib.sha256(base.encode()).hexdigest()
