"""Repeated strings, Merkle proofs and hard negatives against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import hard_negatives, merkle_log, repeats

# --- repeated strings ----------------------------------------------------------------------


def brute_repeats(texts, window=200):
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(b[i : i + window] for b in data for i in range(len(b) - window + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - window + 1):
            if count[b[i : i + window]] > 1:
                gone[i : i + window] = True
        rest = np.frombuffer(b, np.uint8)[~gone[:-1]].tobytes()
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(b) else 0
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def texts_with_repeats():
    r = random.Random(5)
    noise = lambda n: "".join(r.choice("abcdefghij \né") for _ in range(n))
    passages = [noise(r.randint(150, 700)) for _ in range(10)]
    texts = [None, "", "x" * 150, "ab" * 700, "a" * 3000, noise(199), noise(200)]
    for _ in range(80):
        parts = []
        for _ in range(r.randint(1, 6)):
            p, kind = r.choice(passages), r.random()
            if kind < 0.3:
                p = p[r.randint(0, 100) :]
            elif kind < 0.6:
                p = p[: r.randint(100, len(p))]
            elif kind < 0.7:
                j = r.randint(0, len(p) - 1)
                p = f"{p[:j]}#{p[j + 1 :]}"
            parts += [p, noise(r.randint(1, 300))] if r.random() < 0.6 else [p]
        texts.append("".join(parts))
    texts += texts[20:26]
    # one gram in many texts, with other bytes before or behind
    texts += [passages[0] + noise(400) for _ in range(90)] + [noise(300) + passages[1][:230] for _ in range(90)]
    return texts


@pytest.fixture(scope="module")
def repeated(spark):
    texts = texts_with_repeats()
    rows = list(enumerate(texts))
    rows[3] = (None, texts[3])
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).repartition(4)
    return df, collections.Counter((i, *x) for (i, _), x in zip(rows, brute_repeats(texts)))


@pytest.mark.parametrize("options", [
    {},
    {"run_bytes": 20_000, "range_bytes": 30_000},  # many runs, many ranges
    {"run_bytes": 20_000, "range_bytes": 200_000, "fan_in": 3},  # several levels of merges
    {"hot": 20, "run_bytes": 50_000},  # windows of hot grams singly
])
def test_repeats(repeated, options):
    df, wanted = repeated
    assert collections.Counter(tuple(r) for r in repeats.removed_repeats(df, **options).collect()) == wanted


def test_repeats_of_nothing(repeated):
    assert repeats.removed_repeats(repeated[0].filter("1 = 0")).count() == 0


def test_repeats_in_a_very_long_text(spark):
    r = random.Random(8)
    noise = "".join(r.choice("abcdef ") for _ in range(3_000_000))
    passage = "".join(r.choice("ghijkl ") for _ in range(500))
    at = (1 << 20) - 250  # over the end of a piece
    text = noise[:at] + passage + noise[at:]
    rows = [(1, text), (2, f"x{passage[100:]}y")]
    found = {x.doc_id: x for x in repeats.removed_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (found[1].n_bytes, found[1].n_removed, found[1].n_spans) == (len(text), 400, 1)
    rest = text[: at + 100] + noise[at:]
    assert found[1].kept_sha256 == hashlib.sha256(rest.encode()).hexdigest()
    assert (found[2].n_removed, found[2].kept_sha256) == (400, hashlib.sha256(b"xy").hexdigest())


def test_merge_knows_common_prefixes():
    r = random.Random(1)
    for _ in range(200):
        runs = [
            sorted((bytes(r.choice(b"ab") for _ in range(r.randint(0, 12))), 0, None) for _ in range(r.randint(0, 9)))
            for _ in range(r.randint(0, 7))
        ]
        merged = list(repeats.merge([repeats.decode_run(repeats.encode_run(x)) for x in runs]))
        keys = [k for _, k, *_ in merged]
        assert keys == sorted(k for x in runs for k, *_ in x)
        for (_, a, *_), (shared, b, *_) in zip(merged, merged[1:]):
            assert shared == repeats.diverge(a, b, 0)


def test_runs_round_trip():
    entries = sorted([(b"abc", 1, (b"0" * 16, 5)), (b"abd", 0, None), (b"", 0, None), (b"ab", 2, (b"1" * 16, -3))])
    decoded = [(k, b, o) for _, k, b, o in repeats.decode_run(repeats.encode_run(entries))]
    assert decoded == entries


# --- Merkle proofs -----------------------------------------------------------------------


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def path(levels, place):
    """Per level what stands before and behind a node of its run."""
    out = []
    for level in levels[:-1]:
        run = place // 16 * 16
        out.append(("".join(level[run:place]), "".join(level[place + 1 : run + 16])))
        place //= 16
    return out


def brute_manifest(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((own, tree([leaf_of(r) for r in own])))
    top = tree([t[-1][0] for _, t in trees]) if trees else []
    out = collections.Counter()
    for number, (own, levels) in enumerate(trees):
        for place, row in enumerate(own):
            steps = path(levels, place) + path(top, number)
            folded = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                folded = leaf_of((*row[:4], None if row[4] is None else row[4].translate(lower)))
            for before, behind in steps:
                folded = H(before + folded + behind)
            root = top[-1][0]
            proof = H("".join(a + b for a, b in steps))
            out[row[0], leaf_of(row), levels[-1][0], root, proof, folded, folded == root] += 1
    return out


def marked():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def make_rows(n, seed):
    r = random.Random(seed)
    rows = [
        (r.choice([None, *range(n)]), r.choice([None, "", "a", "B", "é", "hot", "hot", "hot"]), r.choice([None, "en"]),
         r.choice([None, 3]), r.choice([None, "", "Text A", "lower", "É", f"T{i}"]))
        for i in range(n)
    ]
    return rows + rows[:5]


@pytest.mark.parametrize("n", [1, 17, 700])
def test_merkle_proofs(spark, n):
    rows = make_rows(n, n)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit(1)).withColumn("level", F.lit("x")).repartition(3)
    found = merkle_log.manifest(df, marked(), {"text": merkle_log.lowered()}).collect()
    assert collections.Counter(tuple(r) for r in found) == brute_manifest(rows)


def test_merkle_proofs_over_several_builders(spark, monkeypatch):
    """Builders of 16 leaves, so that paths lead through four rounds, and many sources."""
    monkeypatch.setattr(merkle_log, "SPAN", 1)
    rows = [(i, "hot" if i % 3 else f"s{i % 301:03d}", "en", i, f"Text {i}") for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = merkle_log.manifest(df, marked(), {"text": merkle_log.lowered()}).collect()
    assert collections.Counter(tuple(r) for r in found) == brute_manifest(rows)


def test_merkle_proofs_of_nothing(spark):
    assert merkle_log.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 16, 17, 255, 256, 257, 4097, 5000])
def test_closed_form_positions(n):
    """Against the order in which a walk completes the nodes."""
    order = []

    def walk(level, place):
        if level:
            count = -(-n // 16 ** (level - 1))
            for child in range(16 * place, min(16 * place + 16, count)):
                walk(level - 1, child)
        order.append((level, place))

    walk(merkle_log.height(n), 0)
    assert [merkle_log.position(level, place, n) for level, place in order] == list(range(len(order)))


def test_positions_as_expressions(spark):
    cases = [
        (level, place, n)
        for n in (1, 5, 16, 17, 300, 5000)
        for level in range(merkle_log.height(n) + 1) for place in range(-(-n // 16**level))
    ]
    df = spark.createDataFrame(cases, "level int, place long, n long")
    found = df.withColumn("p", merkle_log._position(F.col("level"), F.col("place"), F.col("n"), 5000))
    found = found.withColumn("h", merkle_log._height("n", 5000)).collect()
    assert all(r.p == merkle_log.position(r.level, r.place, r.n) and r.h == merkle_log.height(r.n) for r in found)


# --- hard negatives -------------------------------------------------------------------------


def brute_negatives(rows, n_positives=5, n_negatives=3, band=(50, 95)):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(256 * x) for x in v]

    kept = [(i, whole(v), label) for i, v, label in rows]
    kept = [x for x in kept if x[0] is not None and x[1] is not None and x[2] is not None]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = collections.Counter()
    for i, v, label in kept:
        if i % 50:
            continue
        others = sorted((-score(v, w), j, k) for j, w, k in kept if j != i)
        for s, j, k in [x for x in others if x[2] == label][:n_positives]:
            near = [x for x in others if x[2] != label and band[0] * -s <= 100 * -x[0] <= band[1] * -s]
            for rank, (t, m, _) in enumerate(near[:n_negatives], 1):
                out[i, j, rank, m, -s, -t] += 1
    return out


def make_vectors(n, dim, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, dim))
    rows = []
    for i in range(n):
        label = int(r.integers(4))
        rows.append((i, [float(x) for x in np.float32(centres[label] + r.normal(size=dim))], label))
    return rows


VECTORS = "vec_id long, embedding array<float>, label int"


def mined(df, **options):
    found = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **options)
    return collections.Counter(tuple(r) for r in found.collect())


@pytest.mark.parametrize("dim", [3, 64, 100])
def test_hard_negatives(spark, monkeypatch, dim):
    monkeypatch.setattr(hard_negatives, "STEP", 64)
    rows = make_vectors(400, dim, dim)
    rows += [
        (1000, None, 1), (1001, [], 1), (1002, [1.0, None], 1), (1003, [float("nan")] * dim, 1), (None, [1.0] * dim, 1),
        (1004, [float("inf")] * dim, 2), (1005, [1.0] * dim, None), (1050, [0.0] * dim, 1), (1006, [0.5], 2),
        (1100, [2.0] * (dim - 1), 3), rows[7], rows[9], rows[50],
    ]
    df = spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("x")).withColumn("score", F.lit(0)).repartition(3)
    wanted = brute_negatives(rows)
    assert len(wanted) > 20
    assert mined(df) == wanted
    assert mined(df, block=3) == wanted


def test_ties_and_copies_of_vectors(spark):
    rows = [(i, [1.0, 0.5], i % 2) for i in range(120)] + [(200 + i, [0.7, 0.2], 1 - i % 2) for i in range(20)]
    assert mined(spark.createDataFrame(rows, VECTORS)) == brute_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([], VECTORS)
    assert sum(mined(df).values()) == 0
    assert sum(mined(spark.createDataFrame([(50, [1.0], 1)], VECTORS)).values()) == 0


def test_intervals_hold_all_scores():
    r = np.random.default_rng(3)
    for dim, scale in ((64, 50), (64, 1e6), (10, 300), (130, 40)):
        rows = np.floor(r.normal(size=(300, dim)) * scale).astype(np.int64)
        rows[0] = 0
        code, norm, alignment = hard_negatives.codes(rows.astype(float))
        for _ in range(20):
            q = np.floor(r.normal(size=dim) * scale).astype(np.int64)
            low, high = hard_negatives.Anchor(q, hard_negatives.words_for(dim)).bounds(code, norm, alignment)
            exact = rows @ q
            assert (low <= exact).all() and (exact <= high).all()
        # and they tell something: most are narrower than what norms alone allow
        assert np.median(high - low) < 1.7 * np.median(norm) * np.linalg.norm(q)


def test_scores_of_any_size():
    big = np.array([[1 << 40, 3], [-(1 << 40), 5]], dtype=np.int64)
    assert hard_negatives.scores(big, np.array([1 << 20, 7])).tolist() == [(1 << 60) + 21, -(1 << 60) + 35]
    assert hard_negatives.scores(big, np.array([1 << 40, 0])).tolist() == list(hard_negatives.LONG)[::-1]
