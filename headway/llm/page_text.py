"""Main text of web pages by differencing each page with its nearest neighbours.

Within a host, pages with the same lines count as one; the rest are ordered by URL path, and the two
before and the two behind a page are its nearest ones. Their text lines are aligned by longest
common subsequence. A line shared with a neighbour belongs to the site, not to the page, unless
that neighbour shares nearly all lines: then it is a copy, and only lines go that a second
neighbour shares as well. All pages are aligned, those with article elements too: there the
alignment tells whether the article is the page's own. With a line of its own an article stays
whole, because articles of one host share paragraphs; one of shared lines only (teasers, a notice)
gives way to longer own text outside of it, and stays where there is none, as in copies. Elements
that are boilerplate by name (menus, footers, forms, adverts, comments) go as well.

Pages are read twice: first for the hashes of their lines, then for the texts, once the places
of shared lines are known. Only hashes and places are exchanged and stored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import column, hashes_of_runs, numbered, slices, stored

RAW = frozenset("script style textarea title xmp iframe".split())
DROPPED = RAW | frozenset(
    "nav footer aside form button select option dialog menu head canvas audio video label svg math"
    " object noscript template".split()
)
BLOCK = frozenset(
    "p div section article main header footer nav aside ul ol li dl dt dd table thead tbody tfoot tr"
    " td th caption h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption form fieldset address hr"
    " details summary body html head title center dialog menu".split()
)
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
UNWANTED = frozenset(
    "ad ads adv advert advertisement advertisements banner sidebar sidebars menu nav navbar navigation"
    " breadcrumb breadcrumbs footer masthead comment comments disqus reply replies cookie cookies"
    " consent gdpr notice notices newsletter subscribe subscription social share sharing related"
    " recommended promo promotion sponsor sponsored popup modal pagination pager widget widgets"
    " toolbar skip signup login search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
COPY = 0.8  # share of the lines of both that makes a neighbour a copy
MATCHES = 200_000  # pairs of equal lines up to which they are listed

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?", re.I
)
_PART = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _unwanted(rest: str, in_article: bool) -> bool:
    """Whether an element's attributes mark it as boilerplate; in an article by whole names only."""
    for m in _ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.strip().lower() in ROLES:
            return True
        if name in ("class", "id"):
            if in_article:
                if UNWANTED.intersection(value.lower().split()):
                    return True
                continue
            parts = set(_PART.findall(_CAMEL.sub(" ", value).lower()))
            if parts & UNWANTED or "header" in parts:
                return True
    return False


def lines(page: str) -> list[tuple[str, int]]:
    """Text blocks in page order, each with its place: 2 in an article, 1 in the main part,
    0 elsewhere; without the texts of elements that are dropped by their names."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    held_place = 0
    stack: list[tuple[str, bool, int]] = []  # name, dropped, place

    def here() -> tuple[bool, int]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, 0)

    def hold(text: str) -> None:
        nonlocal held_place
        dropped, place = here()
        if text and not dropped:
            held.append(text)
            held_place = place

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, held_place))

    def close(name: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                del stack[i:]
                return
            if stack[i][0] in ("article", "main", "body", "td", "th") and name in ("p", "li", "span", "b", "i", "a"):
                return

    at = 0
    while True:
        m = _MARK.search(page, at)
        if m is None:
            hold(page[at:])
            break
        hold(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            hold(" ")
            continue
        if m["end"]:
            if name in BLOCK:
                flush()
            close(name)
            continue
        if name in BLOCK:
            flush()
            if any(s[0] == "p" for s in stack[-8:]) and name != "p" or stack and stack[-1][0] == "p":
                close("p")
            elif name == "p":
                close("p")
            if name == "li" and stack and stack[-1][0] == "li":
                stack.pop()
        if name in VOID:
            continue
        dropped, place = here()
        place = 2 if name == "article" else max(place, 1) if name == "main" or 'role="main"' in m["rest"] else place
        bad = dropped or name in DROPPED or name == "header" and place < 2 or _unwanted(m["rest"], place == 2)
        if m["rest"].endswith("/"):
            continue
        if name in RAW:
            stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            if stop:
                at = stop.end()
            else:  # never closed: it ends with what it stands in
                parent = re.compile(rf"</{stack[-1][0]}\b", re.I).search(page, at) if stack else None
                at = parent.start() if parent else len(page)
            continue
        stack.append((name, bad, place))
    flush()
    return out


def _matches(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b`` (Hunt and Szymanski)."""
    where: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    tails: list[int] = []
    links: list[tuple] = []
    for i, x in enumerate(a):
        for j in reversed(where.get(x, ())):
            k = bisect_left(tails, j)
            node = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(node)
            else:
                tails[k], links[k] = j, node
    out, node = [], links[-1] if links else None
    while node:
        out.append(node[0])
        node = node[1]
    return out[::-1]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of a longest common subsequence of ``a`` with every prefix of ``b``, by bits."""
    size = len(b)
    full = (1 << size) - 1
    places: dict[int, int] = {}
    for x in set(a):
        places[x] = 0
    marks: dict[int, bytearray] = {}
    for j, x in enumerate(b):
        if x in places:
            marks.setdefault(x, bytearray(size // 8 + 1))[j >> 3] |= 1 << (j & 7)
    for x, bits in marks.items():
        places[x] = int.from_bytes(bits, "little")
    row = full
    for x in a:
        hit = row & places[x]
        if hit:
            row = ((row + hit) | (row - hit)) & full
    data = np.frombuffer(row.to_bytes(size // 8 + 1, "little"), np.uint8)
    return np.concatenate(([0], np.cumsum(1 - np.unpackbits(data, bitorder="little")[:size].astype(np.int64))))


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Where equal lines are many, ``a`` is halved at the best split of ``b`` (Hirschberg), so the
    memory is that of the lines.
    """
    out: list[int] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append(a1)
        if a0 == a1 or b0 == b1:
            continue
        there, here = Counter(b[b0:b1]), Counter(a[a0:a1])
        found = sum(n * there[x] for x, n in here.items())
        if found <= MATCHES or a1 - a0 == 1:
            out.extend(a0 + i for i in _matches(a[a0:a1], b[b0:b1]))
            continue
        middle = (a0 + a1) // 2
        ahead = _lengths(a[a0:middle], b[b0:b1])
        behind = _lengths(a[middle:a1][::-1], b[b0:b1][::-1])[::-1]
        split = b0 + int(np.argmax(ahead + behind))
        work += [(a0, middle, b0, split), (middle, a1, split, b1)]
    return sorted(out)


def _line_hashes(found: list[str]) -> np.ndarray:
    data = [t.encode() for t in found]
    size = np.array([len(d) for d in data], np.int64)
    ends = np.cumsum(size)
    joined = np.frombuffer(b"".join(data), np.uint8)
    return hashes_of_runs(joined, ends - size, ends).view(np.int64)


def _addressed(pages: DataFrame) -> DataFrame:
    """Pages with host, path and a key of their content."""
    address = r"(?is)^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*([^?#]*)"
    url, html = F.coalesce("url", F.lit("")), F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        "page_id", "url", html.alias("html"),
        F.unhex(F.md5(F.concat(url, F.lit("\n"), html))).alias("key"),
        F.lower(F.regexp_extract(url, address, 1)).alias("host"),
        F.regexp_extract(url, address, 2).alias("path"),
    )


def line_hashes(pages: DataFrame) -> DataFrame:
    """Per page its key, host and path, and the hashes of its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                found = [lines(t) for t in column(part, "html").to_pylist()]
                hashes = [_line_hashes([t for t, _ in f]) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[column(part, c) for c in ("key", "host", "path")],
                        pa.array(hashes, pa.list_(pa.int64())),
                    ],
                    names=["key", "host", "path", "hashes"],
                )

    return _addressed(pages).select("key", "host", "path", "html").mapInArrow(
        run, "key binary, host string, path string, hashes array<long>"
    )


def site_lines(own: list[int], others: list[list[int]]) -> list[int]:
    """Places of lines that belong to the site, as the neighbours tell."""
    count: Counter = Counter()
    alone: set[int] = set()
    for other in others:
        same = common_lines(own, other)
        count.update(same)
        if len(same) < COPY * len(own) or len(same) < COPY * len(other):
            alone.update(same)
    return sorted(i for i, n in count.items() if n > 1 or i in alone)


def shared_lines(found: DataFrame) -> DataFrame:
    """Per page (key) the places of lines that belong to its site.

    Pages with the same lines on a host are one: a page that was fetched twice learns from the
    next different one.
    """
    hosted = found.filter((F.col("host") != "") & (F.size("hashes") > 0))
    different = hosted.groupBy("host", "hashes").agg(F.min("path").alias("path"))
    ranked = numbered(different, ["host", "path", "hashes"], "rank")
    steps = F.explode(F.array(*[F.lit(i) for i in (-2, -1, 1, 2)])).alias("step")
    asking = ranked.select("rank", "host", steps)
    near = (
        asking.select(F.col("rank").alias("asker"), (F.col("rank") + F.col("step")).alias("rank"), "host")
        .join(ranked.select("rank", "host", "hashes"), ["rank", "host"])
        .groupBy("asker").agg(F.collect_list("hashes").alias("others"))  # at most four
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, others = column(batch, "hashes").to_pylist(), column(batch, "others").to_pylist()
            shared = [site_lines(a, b) for a, b in zip(own, others)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "host"), column(batch, "hashes"), pa.array(shared, pa.list_(pa.int32()))],
                names=["host", "hashes", "shared"],
            )

    told = ranked.join(near, F.col("rank") == F.col("asker")).select("host", "hashes", "others").mapInArrow(
        run, "host string, hashes array<long>, shared array<int>"
    )
    asked = hosted.select("key", "host", "hashes").dropDuplicates(["key"])
    return asked.join(told.filter(F.size("shared") > 0), ["host", "hashes"]).select("key", "shared")


def own_text(found: list[tuple[str, int]], shared: set[int]) -> str:
    """The main text among the lines of a page, given the places of those that neighbours share.

    Lines inside article elements if one of them is not shared; else own lines in main, else all
    other own ones. An article of shared lines only is a copy or belongs to the site: it stays
    unless the own text outside is longer.
    """
    best = max((p for _, p in found), default=-1)
    own = [(t, p) for i, (t, p) in enumerate(found) if i not in shared]
    if best == 2:
        article = [t for t, p in found if p == 2]
        outside = max((p for _, p in own), default=-1)
        other = [t for t, p in own if p == outside]
        if outside == 2 or sum(map(len, other)) <= sum(map(len, article)):
            return "\n".join(article)
        best = outside
    return "\n".join(t for t, p in own if p == best)


def main_texts(pages: DataFrame) -> DataFrame:
    """Every page with its main text: page_id, url, text (blocks joined by newlines), n_chars.

    A null html counts as empty and gives an empty text. Pages without a host, or alone on it,
    have no neighbours and lose lines by element names only. Equal rows stay. What remains of a
    page is told by ``own_text``. An empty table gives no rows. Only page_id, url and html are
    read, so further columns cannot clash.
    """
    found = stored(line_hashes(pages), "lines")
    shared = stored(shared_lines(found), "shared")
    rows = _addressed(pages).select("page_id", "url", "key", "html")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = []
                for page, gone in zip(column(part, "html").to_pylist(), column(part, "shared").to_pylist()):
                    texts.append(own_text(lines(page), set(gone or ())))
                yield pa.RecordBatch.from_arrays(
                    [column(part, "page_id"), column(part, "url"), pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    return rows.join(shared, "key", "left").mapInArrow(run, schema).withColumn(
        "n_chars", F.length("text").cast("long")
    )
