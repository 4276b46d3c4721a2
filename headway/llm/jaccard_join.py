"""Grouped prefix join: links of Jaccard similarity 0.8 or more between whole texts.

Two texts can be similar only if the rarest of their shingles meet (prefix filter). The
order of shingles is exact: every third one, chosen by its hash, is counted over the whole
corpus and ordered by count, then hash; the others follow, ordered by hash. Texts whose
prefix holds only shingles of their own drop out, which leaves a few per cent of all rows.

Texts with equal sets are one class; classes with equal size and prefix are one group. Pairs
of groups that share a prefix shingle are verified on their first members; then groups are
expanded and the members not yet connected are verified. A long list of a shingle is first
compared with one member per round (its pivot), and pairs already connected are skipped, so
a group of n near copies takes about n comparisons instead of n * n / 2; whatever is still
unconnected at the end is compared pair by pair. No list is cut. Each text carries a parity
bit map of its set: the bits in which two maps differ are no more than the shingles in which
the sets differ, so a pair whose maps differ too much is dropped inside the join.

The rounds find which texts are connected. How many links each has is then counted inside the
components, where all links are: classes of a component are dealt into blocks, every
pair of blocks is one group, and its intersections are products of 0/1 matrices over the
shingles that stand in it twice. Only counts leave a group, no pairs.

Shuffled: 16 bytes per counted shingle, and for the few remaining texts their sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import (
    U64, column, groups, row_key, shingle_sets, slices, stored, words_of,
)

COUNTED = 3  # every third shingle is counted
SHORT_LIST = 32  # lists up to this length are compared pair by pair at once
PIVOT_ROUNDS = 2
MAP = 8  # longs of a parity bit map
BITS = [f"b{i}" for i in range(MAP)]
FLUSH = 1 << 20  # shingles held by a task before it writes them out
UNCOUNTED = 1 << 40  # stands behind every real count
BLOCK_CLASSES = 1500  # classes of a component that are compared with as many others at once
COLUMNS_AT_ONCE = 4096


def needed(size: np.ndarray | int, percent: int):
    """Least shingles of a set that any similar set shares with it."""
    return -(-np.asarray(size) * percent // 100)


def _entries(words: int, percent: int, buckets: int):
    """Per text one row on itself, and its shingles that can be in its prefix, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal hashes, keys, held
            if not hashes:
                return
            h, k = np.concatenate(hashes), np.concatenate(keys)
            bucket = (h >> U64(32)) % U64(buckets)
            order = np.argsort(bucket, kind="stable")
            h, k, bucket = h[order], k[order], bucket[order]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(h)]))
            hashes, keys, held = [], [], 0
            for a in range(0, len(cuts) - 1, 64):
                part = [
                    (int(bucket[i]), h[i:j].tobytes() + k[i:j].tobytes())
                    for i, j in zip(cuts[a : a + 64], cuts[a + 1 : a + 65])
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[0] for p in part], pa.int32()),
                        pa.array([p[1] for p in part], pa.binary()),
                        *[pa.nulls(len(part), pa.int64()) for _ in range(6 + MAP)],
                    ],
                    names=NAMES,
                )

        for batch in batches:
            for piece in slices(batch, "text"):
                own = column(piece, "_key").to_numpy()
                sets = shingle_sets(words_of(column(piece, "text")), words)
                sizes = np.array([len(s) for s in sets], np.int64)
                prefix = np.where(sizes > 0, sizes - needed(sizes, percent) + 1, 0)
                counted = np.zeros(len(sets), np.int64)
                sums, signs = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
                maps = np.zeros((len(sets), MAP), np.int64)
                for i, s in enumerate(sets):
                    if not len(s):
                        continue
                    by_count = s % U64(COUNTED) == 0
                    chosen = s[by_count]
                    counted[i] = len(chosen)
                    if len(chosen) < prefix[i]:
                        chosen = np.concatenate((chosen, s[~by_count][: prefix[i] - len(chosen)]))
                    hashes.append(chosen)
                    keys.append(np.full(len(chosen), own[i]))
                    held += len(chosen)
                    sums[i] = np.add.reduce(s).astype(np.int64)
                    odd = np.bincount((s >> U64(20)) % U64(64 * MAP), minlength=64 * MAP) & 1
                    maps[i] = np.packbits(odd.astype(bool)).view(np.int64)
                    signs[i] = np.bitwise_xor.reduce(s * U64(0x9E3779B97F4A7C15)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.abs(own % buckets), pa.int32()),
                        pa.nulls(len(sets), pa.binary()),
                        pa.array(own),
                        column(piece, "doc_id").cast(pa.int64()),
                        pa.array(sizes), pa.array(counted), pa.array(sums), pa.array(signs),
                        *[pa.array(np.ascontiguousarray(m)) for m in maps.T],
                    ],
                    names=NAMES,
                )
                if held >= FLUSH:
                    yield from flush()
        yield from flush()

    return run


NAMES = ["bucket", "entries", "key", "doc_id", "size", "counted", "sum", "sign", *BITS]
ENTRY_SCHEMA = "bucket int, entries binary, " + ", ".join(f"{c} long" for c in NAMES[2:])
SHARED_NAMES = [*NAMES[2:], "count", "hash"]
SHARED_SCHEMA = ", ".join(f"{c} long" for c in SHARED_NAMES)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows on texts pass; of the shingles in this partition those of two texts or more."""
    names = SHARED_NAMES
    hashes, keys = [], []
    for batch in batches:
        blobs = column(batch, "entries")
        plain = batch.filter(blobs.is_null())
        if plain.num_rows:
            n = plain.num_rows
            yield pa.RecordBatch.from_arrays(
                [*[column(plain, c) for c in names[:-2]], *[pa.nulls(n, pa.int64())] * 2], names=names
            )
        for blob in blobs.drop_null():
            both = np.frombuffer(blob.as_buffer(), U64)
            hashes.append(both[: len(both) // 2])
            keys.append(both[len(both) // 2 :].view(np.int64))
    if not hashes:
        return
    h, k = np.concatenate(hashes), np.concatenate(keys)
    hashes, keys = [], []
    order = np.argsort(h, kind="stable")
    h, k = h[order], k[order]
    same = h[1:] == h[:-1]
    keep = np.zeros(len(h), bool)
    keep[1:] |= same
    keep[:-1] |= same
    h, k = h[keep], k[keep]
    order = np.lexsort((k, h))
    h, k = h[order], k[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (k[1:] != k[:-1])  # equal rows count once
    h, k = h[new], k[new]
    cuts = np.concatenate(([0], np.flatnonzero(h[1:] != h[:-1]) + 1, [len(h)])) if len(h) else [0]
    count = np.repeat(np.diff(cuts), np.diff(cuts)).astype(np.int64)
    count[h % U64(COUNTED) != 0] = UNCOUNTED
    for a in range(0, len(h), 1 << 16):
        part = slice(a, a + (1 << 16))
        n = len(h[part])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(k[part]), *[pa.nulls(n, pa.int64())] * (len(names) - 3),
                pa.array(count[part]), pa.array(h[part].view(np.int64)),
            ],
            names=names,
        )


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with ``_key``, a long that rows share if and only if doc_id and text are equal.

    The key is a hash of 64 bits. Rows whose keys are equal but whose second hashes differ
    are found by one aggregation of both, and all but one of them get another key.
    """
    second = F.xxhash64(F.lit("second"), F.col("doc_id"), F.col("text"), F.length("text"))
    hashed = docs.withColumn("_key", row_key("doc_id", "text"))
    pairs = hashed.select("_key", second.alias("_second")).groupBy("_key").agg(
        F.min("_second").alias("_least"), F.max("_second").alias("_most")
    )
    twins = stored(pairs.filter("_least != _most").select("_key", "_least"), "twins")
    if twins.isEmpty():
        return hashed
    moved = F.when(second != F.col("_least"), F.xxhash64(second, F.col("_key"))).otherwise(F.col("_key"))
    return hashed.join(twins, "_key", "left").withColumn("_key", F.coalesce(moved, "_key")).drop("_least")


def profiles(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per distinct row of ``docs``, which is ``keyed``: set size, set signature, prefix shared with others, and
    how many equal rows there are."""
    spark = docs.sparkSession
    # buckets follow the input, so that one fits into the memory of a task
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    entries = docs.select("doc_id", "text", "_key").mapInArrow(_entries(words, percent, 8 * buckets), ENTRY_SCHEMA)
    shared = entries.repartition(buckets, "bucket").mapInArrow(_shared, SHARED_SCHEMA)
    listed = F.collect_list(F.when(F.col("hash").isNotNull(), F.struct("count", "hash")))
    per_text = shared.groupBy("key").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("size").alias("size"),
        F.max("counted").alias("counted"),
        F.max("sum").alias("sum"),
        F.max("sign").alias("sign"),
        F.count("size").alias("copies"),
        F.sort_array(listed).alias("listed"),
        *[F.max(b).alias(b) for b in BITS],
    )
    length = F.col("size") - F.ceil(F.col("size") * F.lit(percent) / 100) + 1
    known = F.size(F.filter("listed", lambda x: x["count"] < UNCOUNTED))
    alone = F.col("counted") - known  # counted shingles of no other text stand first
    open_ = F.greatest(length - alone, F.lit(0)).cast("int")
    return per_text.select(
        "key", "doc_id", "size", "sum", "sign", "copies", *BITS,
        F.transform(F.slice("listed", 1, open_), lambda x: x["hash"]).alias("prefix"),
        (alone > 0).alias("unique"),
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node`` and ``root`` (least node reachable) of an undirected graph.

    Large-star / small-star steps until nothing changes; each step is two aggregations whose
    partial sums keep a node with many links cheap.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(),
        "edges",
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .filter("u != v").distinct()
        )
        after = stored(small, "edges")
        # nothing left to do: every node hangs on one root that hangs on nothing
        if _stars(after):
            return after.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = after


def _stars(edges: DataFrame) -> bool:
    twice = edges.groupBy("u").count().filter("count > 1").limit(1)
    chained = edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1)
    return twice.isEmpty() and chained.isEmpty()


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                sets = shingle_sets(words_of(column(piece, "text")), words)
                yield pa.RecordBatch.from_arrays(
                    [column(piece, "key"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["key", "shingles"],
                )

    return run


MARKS = 1 << 23  # bits of the filter on keys: one megabyte, whatever the input


def _only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Texts of these keys. A bit map of fixed size lets most others go before the shuffle."""
    spark = docs.sparkSession
    part = F.pmod("key", F.lit(MARKS)) + 1  # these functions count values from 1
    marks = keys.select(F.bitmap_bucket_number(part).alias("n"), F.bitmap_bit_position(part).alias("bit"))
    marks = marks.groupBy("n").agg(F.bitmap_construct_agg("bit").alias("bits"))
    found = {r["n"]: np.frombuffer(bytes(r["bits"]), np.uint8) for r in marks.collect()}
    bits = spark.sparkContext.broadcast(found)
    width = 8 * len(next(iter(found.values()))) if found else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.mod(column(batch, "key").to_numpy(), MARKS)
            keep = np.zeros(len(at), bool)
            number, place = at // width + 1, at % width
            for n in np.unique(number):
                if n in bits.value:
                    own = number == n
                    keep[own] = (bits.value[n][place[own] >> 3] >> (place[own] & 7)) & 1
            yield batch.filter(pa.array(keep))

    rows = docs.select(F.col("_key").alias("key"), "text")
    near = rows.mapInArrow(run, "key long, text string")
    return near.join(keys, "key", "left_semi").dropDuplicates(["key"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    union = F.size("_x") + F.size("_y") - both
    found = pairs.join(left, "a").join(right, "b")
    return found.filter(100 * both >= percent * union).select("a", "b")


def _link_counts(first: pa.Table, block: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Classes of a group with the documents they are linked to in it.

    The group holds the classes of one block, or of two, whose pairs across are counted.
    """
    key, docs = first["class"].to_numpy(), first["docs"].to_numpy()
    sets = first["shingles"].combine_chunks()
    size = sets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(key)), size)
    _, shingle, count = np.unique(sets.flatten().to_numpy(), return_inverse=True, return_counts=True)
    often = count > 1
    number = np.cumsum(often) - 1
    kept = often[shingle]
    row, shingle = row[kept], number[shingle[kept]]
    order = np.argsort(shingle, kind="stable")
    row, shingle = row[order], shingle[order]
    side = first["block"].to_numpy() != block
    left = np.flatnonzero(~side)
    right = np.flatnonzero(side) if side.any() else left
    place = np.zeros(len(key), np.int64)
    place[left], place[right] = np.arange(len(left)), np.arange(len(right))
    both = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(often.sum()), COLUMNS_AT_ONCE):
        a, b = np.searchsorted(shingle, (at, at + COLUMNS_AT_ONCE))
        marks = np.zeros((len(key), min(COLUMNS_AT_ONCE, int(often.sum()) - at)), np.float32)
        marks[row[a:b], shingle[a:b] - at] = 1
        both += marks[left] @ marks[right].T
    union = size[left][:, None] + size[right][None, :] - both
    linked = 100 * both >= percent * union
    if right is left:
        np.fill_diagonal(linked, False)
    yield key[left], linked @ docs[right]
    if right is not left:
        yield key[right], linked.T @ docs[left]


def counted_links(members: DataFrame, percent: int) -> DataFrame:
    """Per class (``class``) the documents of other classes it is linked to (``linked``).

    ``members`` has root, class, docs (documents of the class) and shingles. Classes of a
    component are dealt into blocks by hash, and every pair of blocks meets in one group.
    """
    sizes = members.groupBy("root").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_CLASSES)).cast("int").alias("_blocks")
    )
    own = F.pmod(F.xxhash64("class"), F.col("_blocks")).cast("int")
    dealt = members.join(stored(sizes, "sizes"), "root").withColumn("block", own)
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    met = dealt.withColumn("_other", other).select(
        "root", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"),
        "block", "class", "docs", "shingles",
    )
    by = ["root", "low", "high"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, by):
            for key, linked in _link_counts(group, group["low"][0].as_py(), percent):
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(linked.astype(np.int64))], names=["class", "linked"])

    found = met.repartition(*by).sortWithinPartitions(*by).mapInArrow(count, "class long, linked long")
    return found.groupBy("class").agg(F.sum("linked").alias("linked"))


def _placed(docs: DataFrame, words: int, percent: int, count: bool = False) -> DataFrame:
    """Per distinct row its class and component; ``first`` marks one of each component, and
    ``n_links`` counts the documents that it is linked to, if asked for."""
    profile = stored(profiles(docs, words, percent), "profiles")
    filled = profile.filter("size > 0")
    # equal sets: one class, named by its least key
    classes = filled.groupBy("size", "sum", "sign").agg(F.min("key").alias("class"), F.count(F.lit(1)).alias("n"))
    members = (
        filled.filter(F.size("prefix") > 0)
        .join(classes.filter("n > 1").select("size", "sum", "sign", "class"), ["size", "sum", "sign"], "left")
        .select("key", "size", "prefix", "unique", *BITS, F.coalesce("class", "key").alias("class"))
    )
    members = stored(members, "members")
    units = members.filter(F.col("key") == F.col("class"))
    # one group per size and prefix; a prefix with a shingle of its own is nobody else's
    label = F.xxhash64("size", F.when(F.col("unique"), F.col("key")).otherwise(F.lit(0)), "prefix")
    units = units.select(F.col("key").alias("unit"), "size", "prefix", *BITS, label.alias("group"))
    heads = units.groupBy("group").agg(F.min("unit").alias("head"), F.count(F.lit(1)).alias("in_group"))
    groups = units.join(heads.filter("in_group > 1"), "group", "left").select(
        "unit", "size", "prefix", "group", *BITS, F.coalesce("head", "unit").alias("head"),
        F.coalesce("in_group", F.lit(1)).alias("in_group"),
    )
    lists = groups.select(
        "unit", "size", *BITS, F.expr("unit = head").alias("first"), F.col("unit").alias("root"),
        F.explode(
            F.concat(
                "prefix",
                F.when(F.col("in_group") > 1, F.array("group")).otherwise(F.array().cast("array<bigint>")),
            )
        ).alias("token"),
    )
    counts = lists.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("first")).alias("others")
    ).filter("n > 1")
    lists = stored(lists.join(counts, "token"), "lists")
    sets = stored(
        _only(docs, lists.select(F.col("unit").alias("key")).distinct()).mapInArrow(
            _sets(words), "key long, shingles array<long>"
        ),
        "sets",
    )
    links, tested, roots = None, None, None
    # a short list of first members is done at once; the others are seen again
    again = stored(lists.filter((F.col("n") > SHORT_LIST) | (F.col("others") > 0)), "again")
    for turn in range(PIVOT_ROUNDS + 1):
        if turn == 0:
            firsts = lists.filter("first")
            pairs = _all_pairs(firsts.filter(F.col("n") <= SHORT_LIST), percent).union(
                _pivot_pairs(firsts.filter(F.col("n") > SHORT_LIST), turn, percent)
            ).distinct()
        else:
            labels = roots.withColumnRenamed("node", "unit")
            current = again.drop("root").join(labels, "unit", "left").withColumn(
                "root", F.coalesce("root", "unit")
            )
            mixed_lists = current.groupBy("token").agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
            mixed_lists = mixed_lists.filter("_low != _high").select("token")
            current = stored(current.join(mixed_lists, "token", "left_semi"), "open")
            if current.isEmpty():
                break
            if turn == PIVOT_ROUNDS:
                pairs = _all_pairs(current, percent).distinct()
            else:
                pairs = _all_pairs(current.filter(F.col("n") <= SHORT_LIST), percent).union(
                    _pivot_pairs(current.filter(F.col("n") > SHORT_LIST), turn, percent)
                ).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty() and turn > 0:
            continue  # pivots near nothing new say nothing of the other members of a list
        tested = pairs if tested is None else tested.union(pairs)
        found = stored(_verified(pairs, sets, percent), "links")
        links = found if links is None else links.union(found)
        roots = components(links)
    # classes to components, and those to the least doc_id
    of_key = filled.join(classes.filter("n > 1").select("size", "sum", "sign", "class"), ["size", "sum", "sign"], "left")
    of_key = of_key.select("key", "doc_id", "size", "copies", F.coalesce("class", "key").alias("class"))
    linked = roots.select(F.col("node").alias("class"), "root")
    of_key = of_key.join(linked, "class", "left").withColumn("root", F.coalesce("root", "class"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    least = of_key.groupBy("root").agg(F.min(first).alias("least"), F.count(F.lit(1)).alias("_n"))
    placed = of_key.join(least.filter("_n > 1"), "root", "left").select(
        "doc_id", "copies", F.col("size").alias("n_shingles"),
        F.coalesce("least.doc_id", "doc_id").alias("component_id"), F.col("class").alias("class_id"),
        "key", F.coalesce(F.col("least.key") == F.col("key"), F.lit(True)).alias("first"),
    )
    empty = profile.filter("size = 0").select(
        "doc_id", "copies", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.col("key").alias("class_id"), "key", F.lit(True).alias("first"),
    )
    if not count:
        return placed.union(empty)
    in_class = of_key.groupBy("class").agg(F.sum("copies").alias("docs"))
    nodes = linked.union(linked.select("root", "root").distinct())
    members = nodes.join(in_class, "class").join(sets.withColumnRenamed("key", "class"), "class")
    linked_docs = counted_links(members.select("root", "class", "docs", "shingles"), percent)
    totals = in_class.join(linked_docs, "class", "left").select(
        F.col("class").alias("class_id"),
        (F.coalesce("linked", F.lit(0)) + F.col("docs") - 1).alias("n_links"),
    )
    none = empty.withColumn("n_links", F.lit(0).cast("bigint"))
    return placed.join(totals, "class_id").select(*none.columns).union(none)


def similar_texts(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Links of similarity ``percent`` or more, closed to components.

    Returns per row: doc_id, n_shingles, component_id (least doc_id of its component),
    class_id, which equal sets share, and n_links, the other rows it is linked to, those with an
    equal set included. Null or blank texts have no shingles and no links. Equal
    rows stay as many rows. A null doc_id is a document; its component_id is null only if no
    member has an id. Other columns of ``docs`` are not read.
    """
    every = _placed(keyed(docs.select("doc_id", "text")), words, percent, count=True).drop("key", "first")
    once = every.filter("copies = 1").drop("copies")
    more = every.filter("copies > 1").select(
        "*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_i")
    )
    return once.union(more.drop("copies", "_i"))


def _close(percent: int):
    """Whether a pair of rows, the second with columns ending in 2, can be similar, and is not
    connected already."""
    apart = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"{b}_2"))) for b in BITS), F.lit(0))
    # sets that differ in d shingles have (both - d) / 2 in common and (both + d) / 2 in all
    return (
        (100 * F.least("size", "size2") >= percent * F.greatest("size", "size2"))
        & (F.col("root") != F.col("root2"))
        & (apart * (100 + percent) <= (F.col("size") + F.col("size2")) * (100 - percent))
    )


def _second() -> list:
    return [
        F.col("unit").alias("unit2"), F.col("size").alias("size2"), F.col("root").alias("root2"),
        *[F.col(b).alias(f"{b}_2") for b in BITS],
    ]


def _ordered(found: DataFrame) -> DataFrame:
    return found.select(F.least("unit", "unit2").alias("a"), F.greatest("unit", "unit2").alias("b"))


def _all_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs within a list that can be similar."""
    rows = lists.select("token", "unit", "size", "root", *BITS)
    other = rows.select("token", *_second())
    return _ordered(rows.join(other, "token").filter((F.col("unit") < F.col("unit2")) & _close(percent)))


def _pivot_pairs(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each unit of a list with the pivot of its own and of the next smaller size class.

    Size classes are powers of 100 / percent, so similar sizes are in the same or in
    neighbouring ones. Every round has pivots of its own.
    """
    step = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    rows = lists.select("token", "unit", "size", "root", *BITS, step.alias("step"))
    chance = F.xxhash64("unit", F.lit(turn))
    pivots = rows.groupBy("token", "step").agg(
        F.min(F.struct(chance.alias("c"), *_second())).alias("p")
    ).select("token", "step", "p.*").drop("c")
    near = rows.withColumn("step", F.explode(F.array("step", F.col("step") - 1)))
    return _ordered(near.join(pivots, ["token", "step"]).filter(_close(percent)))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Of every component the row with the least doc_id (rows without one last); all columns
    stay. Of equal rows, in doc_id and text, one stays. Texts without words are all kept.
    """
    rows = keyed(docs)
    others = _placed(rows, words, percent).filter("not first").select(F.col("key").alias("_key"))
    return rows.join(others, "_key", "left_anti").dropDuplicates(["_key"]).select(*docs.columns)
