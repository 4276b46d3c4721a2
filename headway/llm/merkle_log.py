"""Merkle manifest of a dataset as a postorder append log.

Every row is a leaf, every group of rows (a source) a tree of 16 children per node, and the
roots of the groups are the leaves of one last tree. Aligned builders take 16 ** 3 consecutive
nodes of one level each and write the nodes above them in the order of their completion. The
place of any node in the log of its tree follows from sizes of subtrees alone (``position``), so
nodes are written and found without a pass that numbers them: the nodes of a builder lie side by
side, and the siblings of its root, from which all its leaves are proven, are fetched by place.

Null, empty and very long values are leaves like others (a null is ``-``); a row without a group
belongs to the group null, which comes first. Rows of equal key are ordered by their digest,
repeated rows are leaves of their own. An empty table gives no rows. Only the named columns are
read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import groups, numbered, stored

FAN = 4  # bits: 16 children
SPAN = 3  # levels above its own nodes that one builder completes
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
LOG = "tree long, n long, level int, place long, position long, digest binary, key {key}, altered binary"
PROOFS = (
    "{name} {key}, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)
# Levels of the last tree follow those of the groups' trees in a proof.
LAST = 64


def leaf_digest(columns: Sequence[str | Column]) -> Column:
    """SHA-256 of all values, each led by its length in bytes."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def lowered(text: str = "text") -> Column:
    """The text with its A-Z in lower case."""
    return F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return (max(n, 1) - 1).bit_length() + FAN - 1 >> 2


def position(level: int, place: int, n: int) -> int:
    """Place in the postorder log of node ``place`` of a level, in a tree of n leaves.

    Up to its own level all nodes that end where it ends are complete; of higher levels those
    are that end before it starts.
    """
    start = place << FAN * level
    end = min(place + 1 << FAN * level, n)
    done = sum(end + (1 << FAN * j) - 1 >> FAN * j for j in range(level + 1))
    return done + sum(start >> FAN * j for j in range(level + 1, height(n) + 1)) - 1


def parent(children: Iterable[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _builder(base: int, schema: pa.Schema) -> Callable:
    """Completes the levels above consecutive nodes of level ``base``, in postorder."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in groups(batches, ("tree", "block")):
            tree, n = rows["tree"][0].as_py(), rows["n"][0].as_py()
            top = min(base + SPAN, height(n))
            keys, altered = rows["key"].to_pylist(), rows["altered"].to_pylist()
            open_nodes: list[list[str]] = [[] for _ in range(SPAN + 1)]

            def complete(level: int, place: int, digest: str, key=None, other=None) -> None:
                if level > base or base == 0:
                    out.append((tree, n, level, place, position(level, place, n), bytes.fromhex(digest), key, other))
                if level == top:
                    return
                run = open_nodes[level - base]
                run.append(digest)
                end = min(place + 1 << FAN * level, n)
                if place % 16 == 15 or end == n:
                    above, open_nodes[level - base] = parent(run), []
                    complete(level + 1, place >> FAN, above)

            for place, digest, key, other in zip(
                rows["place"].to_pylist(), rows["digest"].to_pylist(), keys, altered
            ):
                complete(base, place, digest.hex(), key, other)
            if len(out) >= 20_000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return build


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema
    )


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def build_log(leaves: DataFrame) -> DataFrame:
    """The append log of all trees.

    ``leaves`` has tree, n (leaves of the tree), place (from 0), digest, key and altered. One
    round per three levels; each reads only the roots that the builders before it wrote.
    """
    spark = leaves.sparkSession
    ddl = LOG.format(key=leaves.schema["key"].dataType.simpleString())
    schema = _arrow(spark, ddl)
    most = leaves.agg(F.max("n")).first()[0] or 0
    log, nodes, base = None, leaves, 0
    while log is None or base < height(most):
        placed = nodes.withColumn("block", F.shiftright("place", FAN * SPAN))
        sorted_rows = placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
        part = stored(sorted_rows.mapInArrow(_builder(base, schema), ddl), "log")
        log = part if log is None else log.unionByName(part)
        base += SPAN
        nodes = part.filter((F.col("level") == base) & (F.col("n") > 1 << FAN * base))
    return log


def _position(level: Column, place: Column, n: Column, most: int) -> Column:
    """``position`` as an expression, for trees of at most ``most`` leaves."""
    bits = level * FAN
    start, end = F.call_function("shiftleft", place, bits), F.least(F.call_function("shiftleft", place + 1, bits), n)
    total = F.lit(-1).cast("long")
    for j in range(height(most) + 1):
        size = 1 << FAN * j
        total = total + F.when(level >= j, F.shiftright(end + (size - 1), FAN * j)).otherwise(
            F.shiftright(start, FAN * j)
        )
    return total


def siblings(nodes: DataFrame, log: DataFrame, most: int) -> DataFrame:
    """For nodes (tree, n, level, place): all nodes beside their path up to the root.

    The log is asked by place; a node asks for at most 15 siblings per level.
    """
    top = height(most)
    if top == 0:
        return nodes.select(
            "tree", "level", "place",
            F.array().cast("array<struct<level:int,place:long,digest:binary>>").alias("beside"),
        )
    path = nodes.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(top - 1)))).filter(
        (F.col("_level") >= F.col("level"))
        & (F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_level") * FAN) < F.col("n"))
    )
    own = F.call_function("shiftright", F.col("place"), (F.col("_level") - F.col("level")) * FAN)
    size = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_level") * FAN)
    count = F.call_function("shiftright", F.col("n") + size - 1, F.col("_level") * FAN)
    asked = (
        path.withColumn("_own", own)
        .withColumn("_first", F.col("_own").bitwiseAND(F.lit(~15)))
        .withColumn("_place", F.explode(F.sequence(F.col("_first"), F.least(F.col("_first") + 15, count - 1))))
        .filter(F.col("_place") != F.col("_own"))
        .withColumn("position", _position(F.col("_level"), F.col("_place"), F.col("n"), most))
    )
    found = asked.join(log.select("tree", "position", "digest"), ["tree", "position"])
    beside = F.sort_array(
        F.collect_list(F.struct(F.col("_level").alias("level"), F.col("_place").alias("place"), "digest"))
    )
    lists = found.groupBy("tree", "level", "place").agg(beside.alias("beside"))
    empty = F.array().cast(lists.schema["beside"].dataType)
    return nodes.select("tree", "level", "place").join(lists, ["tree", "level", "place"], "left").withColumn(
        "beside", F.coalesce("beside", empty)
    )


def _prover(schema: pa.Schema) -> Callable:
    """Proofs of all leaves of a builder, from its part of the log and the nodes above it."""

    def around(places: list[tuple[int, str]], own: int) -> tuple[str, str]:
        return (
            "".join(d for p, d in places if p < own),
            "".join(d for p, d in places if p > own),
        )

    def prove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in groups(batches, ("tree", "block")):
            head = rows.slice(0, 1).to_pylist()[0]
            tree, block, root, subroot = head["tree"], head["block"], head["root"].hex(), head["subroot"].hex()
            levels: dict[int, list[tuple[int, str]]] = {}
            for node in head["beside"]:
                levels.setdefault(node["level"], []).append((node["place"], node["digest"].hex()))
            # above the builder: what stands before and after its path, level by level
            upper = []
            for level in range(SPAN, height(head["n"])):
                upper.append(around(levels.get(level, []), block >> FAN * (level - SPAN)))
            for level in range(height(head["trees"])):
                upper.append(around(levels.get(LAST + level, []), tree >> FAN * level))
            above = "".join(a + b for a, b in upper)

            nodes = rows.slice(1)
            level_of = np.array(nodes["level"].to_pylist())
            place_of = nodes["place"].to_pylist()
            digest_of = [d.hex() for d in nodes["digest"].to_pylist()]
            inner = min(SPAN, height(head["n"]))
            at: list[list[str]] = [[digest_of[i] for i in np.flatnonzero(level_of == j)] for j in range(inner + 1)]
            leaves = np.flatnonzero(level_of == 0)
            keys, altered = nodes["key"].to_pylist(), nodes["altered"].to_pylist()
            first = place_of[leaves[0]]
            for row in leaves.tolist():
                place = place_of[row] - first
                path = []
                for level in range(inner):
                    run, own = place >> FAN * level & ~15, place >> FAN * level
                    path.append(("".join(at[level][run:own]), "".join(at[level][own + 1 : run + 16])))
                proof = "".join(a + b for a, b in path) + above
                leaf = digest_of[row]
                folded = altered[row].hex() if altered[row] is not None else leaf
                for before, after in path:
                    folded = parent((before, folded, after))
                for before, after in upper:
                    folded = parent((before, folded, after))
                out.append((
                    keys[row], leaf, subroot, root,
                    hashlib.sha256(proof.encode()).hexdigest(), folded, folded == root,
                ))
            if len(out) >= 10_000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return prove


def manifest(
    docs: DataFrame,
    altered: Column | None = None,
    changed: dict[str, Column] | None = None,
    columns: Sequence[str] = COLUMNS,
    group: str = "source",
    key: str = "doc_id",
) -> DataFrame:
    """Per row its leaf, the roots, its proof, and the root that the proof gives.

    Rows that ``altered`` marks are proven with the values of ``changed`` in place of their own,
    against the siblings of the unchanged rows: what a checker of a changed copy would see.
    """
    spark = docs.sparkSession
    other = F.lit(None).cast("binary")
    if altered is not None and changed:
        other = F.when(altered, leaf_digest([changed.get(c, F.col(c)) for c in columns]))
    leaves = docs.select(
        F.col(key).alias("key"), F.col(group).cast("string").alias("group"),
        leaf_digest(columns).alias("digest"), other.alias("altered"),
    )
    by_group = F.asc_nulls_first("group")
    rows = numbered(leaves, [by_group, F.asc_nulls_first("key"), "digest", "altered"], "_row")
    sizes = rows.groupBy("group").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("n"))
    trees = numbered(sizes, [by_group], "tree")
    placed = rows.alias("r").join(trees.alias("t"), F.expr("r.group <=> t.group")).select(
        "tree", "n", (F.col("_row") - F.col("_first")).alias("place"), "digest", "key", "altered"
    )
    log = build_log(placed)
    totals = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    most, count = totals[0] or 0, totals[1]

    tops = F.col("level") == _height("n", most)
    subroots = log.filter(tops).select("tree", F.col("digest").alias("subroot"))
    none = F.lit(None)
    last = build_log(
        subroots.select(
            F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"),
            F.col("tree").alias("place"), F.col("subroot").alias("digest"),
            none.cast("long").alias("key"), none.cast("binary").alias("altered"),
        )
    )
    root = last.filter(F.col("level") == height(count)).select("digest").scalar()

    # what stands above a builder: nodes of its own tree, then of the last tree
    blocks = log.filter(
        (F.col("level") == SPAN) | ((F.col("level") < SPAN) & tops)
    ).select("tree", "n", F.lit(SPAN).alias("level"), "place")
    above = siblings(blocks, log.filter(F.col("level") >= SPAN), most).withColumnRenamed("place", "block")
    ends = siblings(
        subroots.select(
            F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"),
            F.lit(0).alias("level"), F.col("tree").alias("place"),
        ),
        last, count,
    ).select(F.col("place").alias("tree"), F.expr(
        f"transform(beside, x -> struct(x.level + {LAST} as level, x.place as place, x.digest as digest))"
    ).alias("_ends"))
    sized = trees.select("tree", "n")
    heads = (
        above.join(sized, "tree").join(subroots, "tree").join(ends, "tree")
        .select(
            "tree", "n", "block", F.lit(-1).cast("long").alias("position"), "subroot", root.alias("root"),
            F.lit(count).cast("long").alias("trees"), F.concat("beside", "_ends").alias("beside"),
        )
    )
    bits = F.least(F.col("level"), F.lit(SPAN)) * FAN
    segment = log.filter(F.col("level") <= SPAN).withColumn(
        "block", F.call_function("shiftright", F.col("place"), F.lit(FAN * SPAN) - bits)
    )
    lined = heads.unionByName(segment, allowMissingColumns=True)
    lined = lined.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")
    ddl = PROOFS.format(name=f"`{key}`", key=docs.schema[key].dataType.simpleString())
    return lined.mapInArrow(_prover(_arrow(spark, ddl)), ddl)


def _height(n: str, most: int) -> Column:
    """``height`` as an expression, for at most ``most`` leaves."""
    found = F.lit(0)
    for level in range(height(most)):
        found = found + (F.col(n) > 1 << FAN * level).cast("int")
    return found
