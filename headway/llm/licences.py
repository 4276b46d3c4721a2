"""Licence scan: matching statistics against a generalised suffix automaton of licence texts.

The automaton holds every run of words of all templates. A file streams through it; after
each word its state is the longest suffix that stands in some template. Maximal matches of
some length are chained, in the order of template and file, into covered template spans.
Words that no template has end every match, so only stretches of known words are streamed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from headway.llm.common import column, slices, words_of

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices of public licences.
TEMPLATES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice
and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED""",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms
of the GNU General Public License as published by the Free Software Foundation, either version 3
of the License, or (at your option) any later version. This program is distributed in the hope
that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: Redistributions of source code must
retain the above copyright notice, this list of conditions and the following disclaimer.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies.""",
    "cc-by": """This work is licensed under a Creative Commons Attribution 4.0 International License.""",
    "cc0": """The person who associated a work with this deed has dedicated the work to the public
domain by waiving all of his or her rights to the work worldwide under copyright law""",
}

MATCH = 5  # words of the shortest match that counts
GAP = 12  # words between matches of one chain, in the file and in the template
COVER = 0.5  # share of a template that a chain covers to give its label


def _inside() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[48:58] = inside[97:123] = inside[128:] = True
    return inside


INSIDE = _inside()  # after lower-casing: digits, letters, all beyond ASCII


class Automaton:
    """Generalised suffix automaton of token sequences.

    Per state: transitions, suffix link, length of its longest run, and the sequence and end
    of one place where that run stands.
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.place = [-1], [0], [(-1, -1)]
        for number, sequence in enumerate(sequences):
            last = 0
            for end, token in enumerate(sequence):
                last = self._extend(last, token, (number, end + 1))

    def _state(self, length: int, link: int, moves: dict, place: tuple[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.place.append(place)
        return len(self.next) - 1

    def _split(self, at: int, token: int, place) -> int:
        """The state behind ``at`` by ``token`` whose longest run is exactly one longer."""
        to = self.next[at][token]
        if self.length[to] == self.length[at] + 1:
            return to
        copy = self._state(self.length[at] + 1, self.link[to], dict(self.next[to]), place)
        self.link[to] = copy
        while at >= 0 and self.next[at].get(token) == to:
            self.next[at][token] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, token: int, place) -> int:
        if token in self.next[last]:
            return self._split(last, token, place)
        new = self._state(self.length[last] + 1, 0, {}, place)
        at = last
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, token, place)
        return new

    def matches(self, tokens: list[int], least: int) -> list[tuple[int, int, int, int]]:
        """Maximal matches of ``least`` tokens or more: file start, length, sequence, place
        in the sequence."""
        out, state, length = [], 0, 0
        for i, token in enumerate([*tokens, -1]):
            moved, now = state, length
            while moved and token not in self.next[moved]:
                moved = self.link[moved]
                now = self.length[moved]
            grows = token in self.next[moved]
            if (not grows or now < length) and length >= least:
                number, end = self.place[state]
                out.append((i - length, length, number, end - length))
            state, length = (self.next[moved][token], now + 1) if grows else (0, 0)
        return out


def chains(found: list[tuple[int, int, int, int]], gap: int = GAP) -> list[tuple[int, int, int, int]]:
    """Matches of one template that follow each other in both orders, joined: template, first
    word, end word, words covered."""
    out: list[list[int]] = []
    for start, length, number, place in sorted(found):
        for chain in reversed(out):
            if chain[0] != number or start - chain[2] > gap:
                continue
            overlap = max(0, chain[2] - start, chain[4] - place)
            if chain[4] - gap <= place <= chain[4] + gap and overlap < length:
                chain[2], chain[4] = start + length, place + length
                chain[3] += length - overlap
                break
        else:
            out.append([number, start, start + length, length, place + length])
    return [tuple(c[:4]) for c in out]


class Scanner:
    """Templates and phrases, prepared once per task."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.labels = list(templates)
        texts = pa.array([*templates.values(), *phrases], pa.string())
        words = words_of(texts, INSIDE)
        parts = [words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        own = parts[: len(templates)]
        self.known = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
        self.sizes = [len(p) for p in own]
        self.automaton = Automaton([np.searchsorted(self.known, p).tolist() for p in own])
        self.phrases = list(zip(parts[len(templates) :], phrases.values()))

    def scan(self, texts: pa.Array) -> list[dict]:
        """Per text: n_words, base places, base labels, template spans."""
        words = words_of(texts, INSIDE)
        out = [
            {"n_words": int(n), "n_base": 0, "first": None, "last": None, "base": set(), "spans": []}
            for n in np.diff(words.first)
        ]
        for phrase, label in self.phrases:
            n = len(phrase)
            if not n or len(words.hashes) < n:
                continue
            at = np.flatnonzero(words.hashes[: len(words.hashes) - n + 1] == phrase[0])
            for j in range(1, n):
                at = at[words.hashes[at + j] == phrase[j]]
            rows = np.searchsorted(words.first, at, side="right") - 1
            whole = at + n <= words.first[rows + 1]
            for place, row in zip((at - words.first[rows])[whole].tolist(), rows[whole].tolist()):
                r = out[row]
                r["n_base"] += 1
                r["base"].add(label)
                r["first"] = place if r["first"] is None else min(place, r["first"])
                r["last"] = place if r["last"] is None else max(place, r["last"])
        if len(words.hashes) and len(self.known):
            ids = np.searchsorted(self.known, words.hashes)
            ids[ids == len(self.known)] = 0
            on = self.known[ids] == words.hashes
            owner = words.rows()
            cut = np.flatnonzero((on[1:] != on[:-1]) | (owner[1:] != owner[:-1])) + 1
            begins = np.concatenate(([0], cut))
            ends = np.concatenate((cut, [len(on)]))
            long = on[begins] & (ends - begins >= MATCH)
            found: dict[int, list] = {}
            for a, b in zip(begins[long].tolist(), ends[long].tolist()):
                for start, length, number, place in self.automaton.matches(ids[a:b].tolist(), MATCH):
                    row = int(owner[a])
                    at = a + start - int(words.first[row])
                    found.setdefault(row, []).append((at, length, number, place))
            for row, matches in found.items():
                out[row]["spans"] = [
                    (self.labels[number], a, b, round(min(1.0, covered / self.sizes[number]), 6))
                    for number, a, b, covered in chains(matches)
                ]
        return out


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string,"
    " labels string, score double, spans string"
)
NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def scan_licences(
    docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None, cover: float = COVER,
) -> DataFrame:
    """Adds to every row: n_words, n_base, first_word, last_word, base_labels, labels, score,
    and spans (``label:first:end:share`` of every chain, in word places, joined).

    A template gives its label when a chain covers ``cover`` of it. The score is 1 where a
    phrase stands, else the largest share covered. A null text counts as empty: no words, no
    labels (empty strings), score 0. Equal rows stay; columns of these names in ``docs`` are
    replaced.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    keep = [c for c in docs.columns if c not in NAMES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for batch in batches:
            for part in slices(batch, text):
                found = scanner.scan(column(part, text))
                labels = [r["base"] | {s[0] for s in r["spans"] if s[3] >= cover} for r in found]
                score = [
                    1.0 if r["n_base"] else max((s[3] for s in r["spans"]), default=0.0) for r in found
                ]
                columns = [
                    pa.array([r["n_words"] for r in found], pa.int64()),
                    pa.array([r["n_base"] for r in found], pa.int64()),
                    pa.array([r["first"] for r in found], pa.int64()),
                    pa.array([r["last"] for r in found], pa.int64()),
                    pa.array([",".join(sorted(r["base"])) for r in found], pa.string()),
                    pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array([",".join(":".join(map(str, s)) for s in r["spans"]) for r in found], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*[column(part, c) for c in keep], *columns], names=[*keep, *NAMES]
                )

    full = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep).mapInArrow(run, f"{full}, {SCHEMA}")
