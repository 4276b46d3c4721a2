"""Balanced label propagation: linked documents share a shard, sizes stay even.

Documents start in blocks of a global order in which links are mostly between neighbours
(for copies: by content), which is balanced to one row. Then each round lets every document
look at the shards of its linked documents and ask for the shard most of them are in; of
those who ask to go from shard a to b, as many go as want to go from b to a, or can be
replaced by documents of b without links, the largest gains first. Such exchanges keep all
counts, so the law of the start holds after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import numbered, stored

SHARDS = 16
ROUNDS = 4


def placed_by_order(nodes: DataFrame, order: list[str], shards: int = SHARDS) -> DataFrame:
    """``nodes`` with rank (0..N-1 in the order) and shard: blocks of the order, counts at
    most one apart."""
    ranked = stored(numbered(nodes, order, "rank"), "ranked")
    total = ranked.count()
    if not total:
        return ranked.withColumn("shard", F.lit(0))
    return ranked.withColumn("shard", F.floor(F.col("rank") * shards / F.lit(total)).cast("int"))


def propagate(nodes: DataFrame, links: DataFrame, rounds: int = ROUNDS, follow: bool = False) -> DataFrame:
    """Moves nodes (``node``, ``shard``) towards their neighbours' shards; ``links`` has a, b.

    A node asks for the shard most neighbours are in, if more of them are there than in its
    own; among equal ones the lowest. Each round asks one half of the nodes, by hash, so that
    neighbours do not swap places; a round that cuts no fewer links is not taken. Links to unknown nodes, to oneself and nulls are ignored,
    repeated links count repeatedly. With ``follow`` only a looks at b, so b stays in its place.
    Nodes without links fill the places of those nobody comes back for. The counts of all shards
    stay exactly as they are.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a != b"), "links")
    shard = nodes.select("node", "shard")
    asking = links.select("a", "b").filter("a != b") if follow else both
    linked = both.select(F.col("a").alias("node")).distinct()
    links, cut = both.filter("a < b"), None
    for turn in range(rounds):
        seen = asking.join(shard.select(F.col("node").alias("b"), F.col("shard").alias("there")), "b")
        votes = seen.groupBy("a", "there").agg(F.count(F.lit(1)).alias("n"))
        here = votes.join(shard.select(F.col("node").alias("a"), "shard"), "a")
        wish = here.groupBy("a", "shard").agg(
            F.max(F.struct("n", (-F.col("there")).alias("low"))).alias("best"),
            F.sum(F.when(F.col("there") == F.col("shard"), F.col("n")).otherwise(0)).alias("own"),
        ).select(
            F.col("a").alias("node"), "shard", (-F.col("best.low")).cast("int").alias("target"),
            (F.col("best.n") - F.col("own")).alias("gain"),
        ).filter("target != shard and gain > 0")
        half = F.pmod(F.shiftright(F.xxhash64("node", F.lit(turn // 2)), 7), F.lit(2)) == turn % 2
        wish = wish.filter(half)
        wish = stored(wish, "wishes")
        flows = {(r["shard"], r["target"]): r["n"] for r in wish.groupBy("shard", "target").agg(
            F.count(F.lit(1)).alias("n")).collect()}  # at most shards * shards rows
        if not flows:
            continue
        cut = cut_links(shard, links) if cut is None else cut
        free = shard.filter(F.col("shard").isin(sorted({t for _, t in flows}))).join(linked, "node", "left_anti")
        free = stored(free, "free")
        left = {r["shard"]: r["n"] for r in free.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        quota, fills = [], []
        given = dict.fromkeys(left, 0)
        for (x, y), n in sorted(flows.items()):
            back = flows.get((y, x), 0)
            fill = min(max(n - back, 0), left.get(y, 0) - given.get(y, 0))
            quota.append((x, y, min(n, back) + fill))
            if fill:
                fills.append((y, x, given[y], given[y] + fill))
                given[y] += fill
        # order within a pair of shards from one global order, so no task holds a whole pair
        moved = _first_of(wish, ["shard", "target"], [F.desc("gain")]).join(
            F.broadcast(_rows(shard, quota, "shard int, target int, quota long")), ["shard", "target"]
        ).filter("place < quota").select("node", "target")
        if fills:
            filling = _first_of(free, ["shard"], []).join(
                F.broadcast(_rows(shard, fills, "shard int, target int, low long, high long")), "shard"
            ).filter("place >= low and place < high").select("node", "target")
            moved = moved.union(filling)
        after = stored(
            shard.join(moved, "node", "left").select("node", F.coalesce("target", "shard").alias("shard")),
            "shards",
        )
        now = cut_links(after, links)
        if now < cut:
            shard, cut = after, now
    return shard


def _first_of(rows: DataFrame, group: list[str], order: list) -> DataFrame:
    """``rows`` with their place (from 0) within the group, in the order, then by hash."""
    ranked = numbered(rows, [*group, *order, F.xxhash64("node")], "rank")
    first = ranked.groupBy(*group).agg(F.min("rank").alias("first"))  # at most shards * shards rows
    return ranked.join(F.broadcast(first), group).withColumn("place", F.col("rank") - F.col("first"))


def _rows(like: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame(rows, schema)


def cut_links(shard: DataFrame, links: DataFrame) -> int:
    """How many links join different shards."""
    a = shard.select(F.col("node").alias("a"), F.col("shard").alias("x"))
    b = shard.select(F.col("node").alias("b"), F.col("shard").alias("y"))
    return links.join(a, "a").join(b, "b").filter("x != y").count()


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """All documents in shards 0 to ``shards`` - 1 under the law ``rows``: counts at most one
    apart, equal texts together as far as a shard holds them.

    Returns doc_id, size (UTF-8 bytes plus 1; null text: 1), text_crc32, law, shard, slot (0..
    within the shard) and grown_shard (null under this law). Every copy of a text is linked to the
    one in the middle of its copies, which lies in the larger part where a border splits them,
    and follows it there. Equal rows stay; a null doc_id is placed first among its copies.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("content"),
    )
    nodes = placed_by_order(narrow, ["content", "text_crc32", "size", "doc_id"], shards)
    nodes = stored(nodes.withColumnRenamed("rank", "node"), "nodes")
    equal = ["content", "text_crc32", "size"]
    copies = nodes.groupBy(*equal).agg(
        (F.min("node") + F.floor(F.count(F.lit(1)) / 2)).alias("b"), F.count(F.lit(1)).alias("_n")
    ).filter("_n > 1")
    links = nodes.join(copies, equal).filter("node != b").select(F.col("node").alias("a"), "b")
    shard = propagate(nodes, links, rounds, follow=True)
    final = nodes.drop("shard").join(shard, "node")
    order = numbered(final.select("node", "shard", "doc_id", "size", "text_crc32"), ["shard", "node"], "rank")
    counts = order.groupBy("shard").agg(F.min("rank").alias("first"))
    return order.join(F.broadcast(counts), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


