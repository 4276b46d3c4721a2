"""The corpus operators against brute force and on awkward tables."""

from __future__ import annotations

import collections
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway.llm import (
    decontamination, jaccard_join, language, licences, packing, page_text, pii, quality,
    sharding, token_counts,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in is on that for with as was by this are from be or an at".split()


def prose(seed: int, n: int) -> str:
    r = np.random.default_rng(seed)
    return " ".join(f"{WORDS[r.integers(20)]}{r.integers(400)}" for _ in range(n))


LONG = prose(1, 30_000)
ROWS = [
    (1, prose(5, 300), "en", "a", 1),
    (2, prose(5, 300), "en", "a", 1),
    (3, prose(5, 300).replace("the1", "THE1") + " tail", "en", "b", 1),
    (3, prose(6, 80), None, None, None),
    (3, prose(6, 80), None, None, None),
    (4, "", "fr", "a", 0),
    (5, None, "fr", "a", None),
    (None, "one two", "fr", "a", 7),
    (6, "one two", "fr", "a", 7),
    (7, " \n\t ", None, "a", 3),
    (8, LONG, "en", "a", 9),
    (9, "Écrire à jean.d+x@mail.example.com ou +1 (555) 555-3918 ou 4111 1111 1111 1111 ip 10.0.0.255",
     "fr", "c", 2),
    (10, "Licensed under the Apache License, Version 2.0. CC BY-SA cc by", "en", "c", 2),
]


@pytest.fixture(scope="module")
def docs(spark):
    # columns that clash with those of the operators
    return spark.createDataFrame(ROWS, SCHEMA).withColumn("score", F.lit("x")).withColumn(
        "spans", F.lit(1)).withColumn("n_words", F.lit("y")).repartition(3)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.filter("1 = 0")


def test_packing_round_trip(docs, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack_documents(docs, RANKS).collect()
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)
    wanted = collections.Counter()
    for doc_id, text, *_ in ROWS:
        wanted[doc_id] += len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    got = collections.Counter()
    for p in pieces:
        got[p.doc_id] += p.length
    assert got == wanted
    ids = tokenizer.encode(LONG, add_special_tokens=False).ids + [1]
    at = 0
    for p in sorted((p for p in pieces if p.doc_id == 8), key=lambda p: p.start):
        assert p.start == at and p.doc_tokens == len(ids)
        assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *ids[at : at + p.length]))
        at += p.length
    assert at == len(ids)
    assert packing.pack_documents(nothing, RANKS).count() == 0


def test_packing_keeps_all_limits(spark):
    r = np.random.default_rng(3)
    rows = [(i, int(r.integers(1, 900)), int(r.integers(1, 5)), int(r.integers(0, 400))) for i in range(500)]
    rows += [(500, 9999, 1, 1), (None, None, None, None)]
    placed = packing.pack_examples(
        spark.createDataFrame(rows, "k long, t long, s long, l long"), "k", "t", "s", "l", (2048, 8, 700)
    ).collect()
    assert len(placed) == len(rows)
    sums = collections.defaultdict(lambda: np.zeros(3))
    for p in placed:
        if p.sequence_id is None:
            assert p.k == 500
        else:
            sums[p.sequence_id] += (p.tokens, p.segments, p.loss)
    assert all((s <= (2048, 8, 700)).all() for s in sums.values())


@pytest.mark.parametrize("text", ["a  b\n\n c", "é中\U0001f600 'll x", "<|endoftext|> y", "1234567 89", ""])
def test_rank_file_gives_the_ids_of_the_tokenizer(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.encoded(text, RANKS).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_token_counts(docs, nothing):
    found = token_counts.count_documents(docs, RANKS, block=64).collect()
    wanted = sorted(((d, len(token_counts.ordinary_ids(t or "", RANKS))) for d, t, *_ in ROWS), key=repr)
    assert sorted(((r.doc_id, r.n_tokens) for r in found), key=repr) == wanted
    assert token_counts.count_documents(nothing, RANKS).count() == 0


def test_token_files_without_a_last_separator(spark):
    data = np.array([7, 0, 0, 7, 7, 7], "<u2")
    rows = [(1, i, data[i * 2 : i * 2 + 2].tobytes()) for i in range(3)]
    blocks = spark.createDataFrame(rows, "file long, block long, data binary")
    found = sorted(tuple(r)[1:] for r in token_counts.token_counts(blocks, 0, 2).collect())
    assert found == [(0, 0, 1, True), (1, 2, 0, True), (2, 3, 3, False)]


def test_ids_of_all_given_documents():
    """The rank file gives the ids of the JSON file, on every document and on odd texts."""
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].drop_null().to_pylist()
    r = np.random.default_rng(2)
    odd = ["".join(chr(c) for c in r.choice([*range(9, 14), 32, 39, *range(48, 123), 233, 8364, 0x1F600], 80)) for _ in range(300)]
    for text in [*texts, *odd, "a<|endoftext|>b"]:
        assert packing.encoded(text, RANKS).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_of_conversations(spark):
    """Examples whose tokens, turns and loss-bearing tokens differ, under limits that all bind."""
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    size = F.size(F.split("text", " "))
    examples = turns.groupBy("conv_id").agg(
        F.sum(size).alias("tokens"), F.count(F.lit(1)).alias("segments"),
        F.sum(F.when(F.col("role") == "assistant", size).otherwise(0)).alias("loss"),
    )
    rows = examples.collect()
    limits = tuple(4 * max(r[c] for r in rows) for c in ("tokens", "segments", "loss"))
    found = packing.pack_examples(examples.repartition(1), "conv_id", "tokens", "segments", "loss", limits).collect()
    assert sorted(r.conv_id for r in found) == sorted(r.conv_id for r in rows)
    sums = collections.defaultdict(lambda: np.zeros(3))
    for r in found:
        sums[r.sequence_id] += (r.tokens, r.segments, r.loss)
    assert all((s <= limits).all() for s in sums.values())
    assert sum(r.loss < r.tokens for r in rows) > 0.5 * len(rows)
    # not far from the least number that any of the limits allows
    total = sum(sums.values())
    assert len(sums) <= 1.3 * (total / limits).max() + 2


def brute_spans(text: str) -> str:
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and max(int(x) for x in m.group().split(".")) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_exact_spans_of_random_texts():
    r = np.random.default_rng(0)
    for _ in range(3000):
        text = "".join(r.choice(list("a1.@-+ 4é("), r.integers(0, 40)))
        assert pii.joined(pii.exact_spans(text)) == brute_spans(text), text
    assert pii.exact_spans("0" * 5000 + ".1.1.1") == [("ip", 0, 5006)]


def test_field_learns_and_decodes_best_paths():
    table = [(f"call +1 ({a}) 555-{b} now", [("phone", 5, 22)]) for a, b in zip(range(200, 260), range(1000, 1060))]
    table += [(f"see page {a} of {b}", []) for a, b in zip(range(10, 60), range(100, 150))]
    field = pii.train(table)
    rows = [pii.shapes(t, pii.tokens(t)) for t, _ in table[:3]] + [["x1"], []]
    score, lengths = field.scores(rows)
    for i, path in enumerate(field.decode(rows)):
        n = int(lengths[i])
        assert len(path) == n
        if 0 < n <= 7:  # all paths
            import itertools

            def worth(p):
                return sum(score[i, t, x] for t, x in enumerate(p)) + sum(field.change[a, b] for a, b in zip(p, p[1:]))

            assert worth(path) >= max(map(worth, itertools.product(range(5), repeat=n))) - 1e-9
    found = pii.Finder(field).find(pa.array(["x +1 (777) 555-1234 y", None, "page 12 of 130"]))
    assert [len(f[1]) for f in found] == [1, 0, 0]


def test_personal_data(docs, nothing):
    field = pii.train(pii.labelled_sample(docs))
    found = pii.find_personal_data(docs, field).collect()
    assert len(found) == len(ROWS)
    texts = collections.Counter((d, brute_spans(t or "")) for d, t, *_ in ROWS)
    assert collections.Counter((r.doc_id, r.base) for r in found) == texts
    row = next(r for r in found if r.doc_id == 9)
    assert (row.n_email, row.n_phone) == (1, 1) and "@" not in row.masked and row.score == "x"
    assert next(r for r in found if r.doc_id == 5).masked is None
    assert set(row.base.split(",")) <= set(row.spans.split(","))
    assert pii.find_personal_data(nothing, pii.train([])).count() == 0


def brute_sets(rows):
    sets = []
    for doc_id, text in rows:
        w = [x.lower() for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        sets.append((doc_id, frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())))
    return sets


def brute_components(rows):
    sets = brute_sets(rows)
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return collections.Counter((d, len(s), least.get(top(i))) for i, (d, s) in enumerate(sets))


def brute_links(rows):
    """Per row how many other rows it is linked to."""
    sets = [s for _, s in brute_sets(rows)]
    return collections.Counter(
        (rows[i][0], sum(
            bool(a and b) and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets) if j != i
        ))
        for i, a in enumerate(sets)
    )


def test_keys_of_unequal_rows(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "row_key", lambda *c: F.lit(7).cast("bigint"))  # all collide
    rows = [(i % 4, f"text {i % 5}") for i in range(40)] + [(None, None), (0, None)]
    keyed = jaccard_join.keyed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({(r.doc_id, r.text) for r in keyed}) == len({r._key for r in keyed}) == 22


def test_jaccard_join(spark, docs, nothing, monkeypatch):
    found = jaccard_join.similar_texts(docs).collect()
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found)
    wanted = brute_components([(d, t) for d, t, *_ in ROWS])
    # equal rows without words have no class to share
    assert got == wanted
    assert collections.Counter((r.doc_id, r.n_links) for r in found) == brute_links([(d, t) for d, t, *_ in ROWS])
    assert jaccard_join.similar_texts(nothing).count() == 0


def test_jaccard_join_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 4)
    r = np.random.default_rng(7)
    base = prose(11, 60).split()
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(r.integers(0, 4)):
            words[r.integers(60)] = f"new{r.integers(6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, prose(50 + i % 20, int(r.integers(1, 40)))) for i in range(100)]
    # blocks of a component smaller than it, and shingles in several portions
    monkeypatch.setattr(jaccard_join, "BLOCK_CLASSES", 20)
    found = jaccard_join.similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter((x.doc_id, x.n_shingles, x.component_id) for x in found) == brute_components(rows)
    links = brute_links(rows)
    assert sum(n * c for (_, n), c in links.items()) > 2000
    assert collections.Counter((x.doc_id, x.n_links) for x in found) == links


def test_jaccard_join_of_a_sparse_family(spark):
    # one long list of texts far from each other, but for three pairs that no pivot is part of
    r = np.random.default_rng(1)
    base = prose(12, 200).split()
    spots = [r.choice(np.arange(5, 195), 4, replace=False) for _ in range(100)]
    rows = []
    for i, places in enumerate([*spots, *spots[:3]]):
        words = list(base)
        for p in places:
            words[p] = f"own{i}"
        rows.append((i, " ".join(words)))
    wanted = brute_components(rows)
    assert len({c for _, _, c in wanted}) == 100
    found = jaccard_join.similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter((x.doc_id, x.n_shingles, x.component_id) for x in found) == wanted


def test_one_of_each(docs, nothing):
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == [1, 10, 3, 4, 5, 6, 7, 8, 9]  # 3: its other text; the row without id is like 6
    assert jaccard_join.one_of_each(nothing).count() == 0


def test_components(spark):
    r = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    wanted = {x: top(x) for x in list(parent) if top(x) != x}
    got = jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x.node: x.root for x in got if x.node != x.root} == wanted


def test_sharding(docs, nothing, spark):
    found = sharding.shard_documents(docs, shards=4).collect()
    counts = collections.Counter(r.shard for r in found)
    assert len(found) == len(ROWS) and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(counts[shard]))
    sizes = collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in ROWS)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in found) == sizes
    assert sharding.shard_documents(nothing).count() == 0


def test_sharding_keeps_copies_together_over_borders(spark):
    rows = [(i, f"copy {i % 12}") for i in range(60)] + [(100 + i, f"lone {i}") for i in range(67)]
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect()
    assert sorted(r.doc_id for r in found) == [d for d, _ in rows]
    counts = collections.Counter(r.shard for r in found)
    assert len(counts) == 8 and max(counts.values()) - min(counts.values()) <= 1
    shards = collections.defaultdict(set)
    for r in found:
        if r.doc_id < 100:
            shards[r.doc_id % 12].add(r.shard)
    assert [len(s) for s in shards.values()] == [1] * 12


def test_propagation_cuts_fewer_links_and_keeps_counts(spark):
    nodes = spark.createDataFrame([(i, i % 4) for i in range(80)], "node long, shard int")
    links = spark.createDataFrame([(i, j) for g in range(20) for i in range(4 * g, 4 * g + 4) for j in range(4 * g, i)], "a long, b long")
    moved = sharding.propagate(nodes, links, rounds=4)
    assert sharding.cut_links(moved, links) < sharding.cut_links(nodes, links)
    assert sorted(r["count"] for r in moved.groupBy("shard").count().collect()) == [20] * 4


PAGES = [
    (1, "https://a.example/x/1", "<nav>Menu</nav><div>Site line</div><p>First&nbsp;own  text &amp; more<p>Second<script>var t='</p>'</script><footer>f</footer>"),
    (2, "https://a.example/x/2", "<nav>Menu</nav><div>Site line</div><p>Other own text<div class='user-comments'>no</div>"),
    (3, "https://a.example/x/3", "<div>Site line</div><p>Third<br>line</p><form>f<input></form>"),
    (4, "https://b.example/", "<article><h1>T</h1><p><b>A.<br><p>B</article><aside>s</aside>"),
    (5, None, None),
    (6, "https://b.example/2", ""),
    (None, "https://b.example/1", "<article><p>B</p><div class='ad'>x</div></article>"),
]


def test_page_text(spark):
    pages = spark.createDataFrame(PAGES + [PAGES[3]], "page_id long, url string, html string")
    got = collections.Counter((r.page_id, r.text, r.n_chars) for r in page_text.main_texts(pages).collect())
    texts = {
        1: "First own text & more\nSecond", 2: "Other own text", 3: "Third line", 4: "T\nA.\nB",
        5: "", 6: "", None: "B",
    }
    wanted = collections.Counter((p, texts[p], len(texts[p])) for p, *_ in [*PAGES, PAGES[3]])
    assert got == wanted
    assert page_text.main_texts(pages.filter("1 = 0")).count() == 0


@pytest.mark.parametrize("page, wanted", [
    ('<article><p>a</p><svg width="1"/><p>kept</p></article>', "a\nkept"),
    ("<article>a<svg><svg></svg>gone</svg>b<object><p>gone</object></article>c", "ab"),
    ("<article><p>a<iframe>gone</article><p>b", "a"),
    ('<article><p class="notice-period">a</p><p class="notice">gone</p></article>', "a"),
    ("<article>a<button>gone</button>b<label>gone</label></article>", "ab"),
    ("<article>a<script>if (x < 1) { '<p>' }", "a"),
])
def test_elements_that_hide_text(page, wanted):
    found = page_text.lines(page)
    best = max(place for _, place in found)
    assert "\n".join(text for text, place in found if place == best) == wanted


def test_neighbours_tell_site_lines(spark):
    """Two fetches of a page learn from the next different one; a frame of most lines goes."""
    frame = "".join(f"<div>Frame {i}</div>" for i in range(9))
    pages = [(i, f"https://a.example/{i // 2}", f"{frame}<p>Own text {i // 2}</p>") for i in range(8)]
    pages += [(100 + i, f"https://b.example/{i}", f"<div>Top</div><p>Text {i}</p>") for i in range(5)]
    # a copy of a page under another address keeps its own lines
    copied = "".join(f"<p>Story {i}</p>" for i in range(9))
    pages += [(200, "https://c.example/a", f"{copied}<p>One</p>"), (201, "https://c.example/b", f"{copied}<p>Two</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("shared", F.lit(1))
    found = {r.page_id: r.text for r in page_text.main_texts(df).collect()}
    story = "\n".join(f"Story {i}" for i in range(9))
    wanted = {i: f"Own text {i // 2}" for i in range(8)} | {100 + i: f"Text {i}" for i in range(5)}
    assert found == wanted | {200: f"{story}\nOne", 201: f"{story}\nTwo"}


def test_neighbours_judge_articles(spark):
    """Teasers that all pages share give way to longer own text; articles with own lines stay whole,
    and so do copies of an article."""
    teasers = "".join(f"<article><p>Teaser {i}</p></article>" for i in range(3))
    story = "The own story of page {} is told at length outside of any article element."
    pages = [(i, f"https://a.example/{i}", f"{teasers}<div>{story.format(i)}</div>") for i in range(5)]
    pages += [(10 + i, f"https://b.example/{i}", f"<article><p>Common</p><p>Own {i}</p></article>")
              for i in range(5)]
    copied = "<article><p>One story</p><p>that is fetched often</p></article>"
    pages += [(20 + i, f"https://c.example/{i}", f"{copied}<div>Views: {i}</div>") for i in range(5)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in page_text.main_texts(df).collect()}
    wanted = {i: story.format(i) for i in range(5)} | {10 + i: f"Common\nOwn {i}" for i in range(5)}
    assert found == wanted | {20 + i: "One story\nthat is fetched often" for i in range(5)}


def test_main_texts_against_brute_force(spark):
    r = np.random.default_rng(6)
    pages = []
    for i in range(60):
        lines = [f"Line {r.integers(12)}" for _ in range(r.integers(0, 9))]
        pages.append((i, f"https://h{r.integers(3)}.example/{r.integers(25)}", "".join(f"<p>{t}</p>" for t in lines)))
    hosts = collections.defaultdict(dict)
    own = {}
    for i, url, html in pages:
        host, path = re.match(r"https://([^/]*)(.*)", url).groups()
        texts = tuple(t for t, _ in page_text.lines(html))
        own[i] = (host, texts)
        if texts:
            hosts[host][texts] = min(path, hosts[host].get(texts, path))
    found = {x.page_id: x.text for x in page_text.main_texts(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i, (host, texts) in own.items():
        if not texts:
            assert found[i] == ""
            continue
        # of equal paths the order of the hashes decides: any order of them may be right
        order = sorted(hosts[host].items(), key=lambda x: x[1])
        paths = [p for _, p in order]
        if len(set(paths)) < len(paths):
            continue
        at = [t for t, _ in order].index(texts)
        near = [order[j][0] for j in (at - 2, at - 1, at + 1, at + 2) if 0 <= j < len(order)]
        gone = set(page_text.site_lines(list(texts), [list(t) for t in near]))
        assert found[i] == "\n".join(t for j, t in enumerate(texts) if j not in gone)


def test_common_lines_of_many_equal_ones():
    a, b = [0] * 30_000, [1] + [0] * 15_000 + [2] + [0] * 9_000
    assert len(page_text.common_lines(a, b)) == 24_000


def test_longest_common_subsequence(monkeypatch):
    r = np.random.default_rng(4)
    for i in range(300):
        monkeypatch.setattr(page_text, "MATCHES", 200_000 if i % 2 else 3)
        a, b = r.integers(0, 5, r.integers(0, 12)).tolist(), r.integers(0, 5, r.integers(0, 12)).tolist()
        size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
        places = page_text.common_lines(a, b)
        rest = iter(b)
        assert len(places) == size[-1][-1] and places == sorted(set(places))
        assert all(a[p] in rest for p in places)


def brute_code(model, samples, language_name, text, order, least):
    """Bits of a text, counted and excluded symbol by symbol."""
    def classes(t):
        return [int(model.symbol[b]) for b in language.LOWER[np.frombuffer(t.encode(), np.uint8)]]

    size = len(model.share)
    counts = collections.defaultdict(collections.Counter)
    sym = classes("\n".join(samples[language_name]))
    for k in range(order + 1):
        padded = [0] * k + sym
        for i, s in enumerate(sym):
            counts[tuple(padded[i : i + k])][s] += 1

    def chances(context):
        own = counts.get(context)
        if context and (own is None or own.total() < least):
            return chances(context[1:])
        lower = chances(context[1:]) if context else [1 / size] * size
        rest = sum(p for s, p in enumerate(lower) if s not in own)
        escape = len(own) if rest > 1e-9 else 0
        return [
            own[s] / (own.total() + escape) if s in own
            else escape / (own.total() + escape) * lower[s] / rest if rest > 1e-9 else 0
            for s in range(size)
        ]

    bits, before = 0.0, [0] * order
    for s in classes(text):
        row = chances(tuple(before[len(before) - order :]))
        assert abs(sum(row) - 1) < 1e-6
        bits += -np.log2(max(row[s], 1e-12)) + model.share[s]
        before.append(s)
    return bits


@pytest.mark.parametrize("order, least", [(0, 1), (2, 1), (4, 3)])
def test_code_lengths(order, least):
    samples = {"en": [prose(i, 60) for i in range(3)], "fr": ["écrire été là-bas où " * 9, "Où?\tlà"], "none": [""]}
    model = language.fit(samples, order, least)
    assert model.languages == ["en", "fr"]
    texts = ["the of and", "Écrire  the été\n", "", "zz日本 of1", prose(9, 20), None, "o"]
    bits = model.bits(pa.array(texts))
    for text, row in zip(texts, bits):
        wanted = [brute_code(model, samples, g, text or "", order, least) for g in model.languages]
        assert np.allclose(wanted, row[:-1], rtol=1e-4, atol=1e-3)


def test_long_texts_are_coded_whole():
    model = language.fit({"en": [prose(1, 300)]})
    text = prose(3, 150_000)  # over several steps
    parts = [text[i : i + 1000] for i in range(0, len(text), 1000)]
    whole, pieces = model.bits(pa.array([text]))[0], model.bits(pa.array(parts)).sum(axis=0)
    assert abs(whole[0] - pieces[0]) < 0.02 * whole[0] and abs(whole[1] - pieces[1]) < 1


def test_language(docs, nothing, spark):
    samples = {"en": [prose(i, 200) for i in range(3)], "xx": ["zzq qqz zqzq " * 50]}
    model = language.fit(samples)
    found = language.identify(docs, model).collect()
    assert len(found) == len(ROWS)
    by_id = {r.doc_id: r for r in found}
    assert by_id[5].lang_pred == by_id[4].lang_pred == by_id[7].lang_pred == "und"
    assert by_id[8].lang_pred == "en" and 0.2 < by_id[8].score <= 1 and by_id[5].score == 0
    noise = spark.createDataFrame([(1, "".join(chr(97 + (i * i * 7919 + i // 5) % 26) for i in range(900)))], "doc_id long, text string")
    assert language.identify(noise, model).first().score == 0
    assert language.identify(nothing, language.fit({})).count() == 0
    assert {r.lang_pred for r in language.identify(docs, language.fit({})).collect()} == {"und"}


def test_training_sample_of_copies_and_long_texts(spark):
    rows = [("a", f"text {i}") for i in range(6)]
    rows += [("a", f"text {i}") for i in range(6) for _ in range(20)]
    rows += [("b", "x" * 20_000 + "y" * 20_000 + "z" * 20_000), ("b", "x" * language.TRAIN_TEXT)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    texts = collections.defaultdict(list)
    for r in language.training_sample(docs, F.lit(True), 4).collect():
        texts[r.lang].append(r.text)
    assert len(texts["a"]) == len(set(texts["a"])) == 4
    assert sorted(map(len, texts["b"])) == [language.TRAIN_TEXT] * 2
    assert {"".join(sorted(set(t))) for t in texts["b"]} == {"x", "xyz"}


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    rows = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(rows) - len(set(rows)), len(covered),
    )


def test_quality(spark, docs, nothing):
    extra = [(100, "a b c a b c a\na b\na b\n#x $"), (101, "a a a a a"), (102, "é \U0001f600 <&>")]
    table = docs.select("doc_id", "text", "n_words").union(
        spark.createDataFrame(extra, "doc_id long, text string").withColumn("n_words", F.lit("z"))
    )
    found = quality.judged(table, []).collect()
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
    assert got == collections.Counter((d, *brute_quality(t)) for d, t in [*[(r[0], r[1]) for r in ROWS], *extra])
    assert all(r.kept != r.base_failed for r in found)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.learned(nothing, labels) == []
    assert quality.judged(nothing, []).count() == 0


def test_decision_list_learns_a_conjunction(spark):
    r = np.random.default_rng(1)
    rows = []
    for i in range(900):
        row = {f: float(r.random()) for f in quality.FEATURES}
        row["bad"] = int(row["symbol_share"] > 0.8 or row["n_words"] < 0.1)
        row["fold"] = i % 3
        rows.append(row)
    rules = quality.learn(rows)
    assert rules
    wrong = sum(any(all(c.holds(x) for c in rule) for rule in rules) != bool(x["bad"]) for x in rows)
    assert wrong < 60
    plan = quality.judged(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), rules)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_licences(docs, nothing):
    found = {(r.doc_id, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licences.scan_licences(docs).collect()}
    assert (10, 3, 3, 11, "apache,cc-by") in found and (5, 0, None, None, "") in found
    assert licences.scan_licences(nothing).count() == 0
    scanner = licences.Scanner(licences.TEMPLATES, licences.PHRASES)
    mit = licences.TEMPLATES["mit"].upper()
    (row,) = scanner.scan(pa.array(["x " + mit + " y"]))
    label, a, b, share = max(row["spans"], key=lambda s: s[3])
    assert (label, a, share) == ("mit", 1, 1.0)


def test_automaton_gives_matching_statistics():
    r = np.random.default_rng(5)
    for _ in range(100):
        texts = [r.integers(0, 3, r.integers(1, 12)).tolist() for _ in range(3)]
        stream = r.integers(0, 4, 30).tolist()
        runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        wanted = []
        for end in range(1, len(stream) + 1):
            longest = max((n for n in range(end + 1) if tuple(stream[end - n : end]) in runs), default=0)
            grows = end < len(stream) and tuple(stream[end - longest : end + 1]) in runs
            if longest >= 2 and not grows:
                wanted.append((end - longest, longest))
        found = licences.Automaton(texts).matches(stream, 2)
        assert [(s, n) for s, n, *_ in found] == wanted
        assert all(texts[k][p : p + n] == stream[s : s + n] for s, n, k, p in found)


def test_decontamination(spark, docs, nothing):
    item = prose(77, 30)
    near = item.split()
    near[29] = "changed"
    rows = [
        (1, prose(1, 100) + " " + item.upper() + " " + prose(2, 100)),
        (2, prose(3, 50) + "\n" + " ".join(near) + " x"),
        (3, prose(4, 100)), (4, None), (5, ""), (None, item), (6, item + " " + item),
        (7, " ".join(item.split()[:20])), (8, "a tiny one"),
    ]
    items = spark.createDataFrame([(9, item), (10, None), (11, ""), (12, "A tiny one")], "item_id long, text string")
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    found = decontamination.contaminations(table, items).collect()
    got = {(r.doc_id, r.item_id, r.start_word) for r in found}
    # a window one word earlier is as similar as the one that ends in the changed word
    assert got == {(1, 9, 100), (2, 9, 49), (None, 9, 0), (6, 9, 0), (8, 12, 0)}
    kept = decontamination.without_benchmark(table, items)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7] and kept.columns == table.columns
    assert decontamination.contaminations(nothing, items).count() == 0
    assert decontamination.contaminations(table, items.filter("1 = 0")).count() == 0


def test_decontamination_of_texts_shorter_than_an_item(spark):
    item = prose(78, 59).split()
    rows = [
        (1, " ".join(item[:54])), (2, " ".join(item[5:])), (3, " ".join(item[:30] + item[31:])),
        (4, " ".join(item[:48])), (5, " ".join(item[:47])), (6, " ".join(item[:10])), (7, " ".join(item[:3])),
    ]
    items = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontamination.contaminations(table, items).collect()
    got = {(r.doc_id, r.item_id, r.start_word, r.n_words, round(r.similarity, 9)) for r in found}
    shares = {1: (54, 50 / 55), 2: (54, 50 / 55), 3: (58, 50 / 59), 4: (48, 44 / 55)}
    assert got == {(i, 9, 0, n, round(s, 9)) for i, (n, s) in shares.items()}
    assert sorted(r.doc_id for r in decontamination.without_benchmark(table, items).collect()) == [5, 6, 7]


def test_multi_index_finds_all_within_the_radius():
    r = np.random.default_rng(6)
    prints, queries = (r.integers(0, 256, (60, 8), dtype=np.uint8) for _ in range(2))
    queries[:30] = prints[:30] ^ (r.random((30, 8)) < 0.5) * np.uint8(5)
    gap = decontamination.distance(queries[:, None, :], prints[None, :, :])
    q, m = decontamination.MultiIndex(prints, 24).search(queries)
    assert set(zip(q.tolist(), m.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(gap <= 24))))
