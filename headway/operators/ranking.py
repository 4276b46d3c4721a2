"""First rows, samples, tops, splits and numbering.

Rankings inside a group always ask for a limited number of rows (``row_number() <= n``
with n below ``spark.sql.optimizer.windowGroupLimitThreshold``), which Spark applies in
every task before the shuffle: a group holding a third of all rows sends n rows per
task. Where every row needs its rank, ranks are put together from counts of hash slots.

Random choices order rows by the MD5 of their key and a seed: the same rows for the same
seed, whatever the partitioning, and any other engine can repeat the choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.schema import FEED, POSITION
from headway.session import kept, materialise

SLOT_DIGITS = 3  # leading hex digits of the hash, 4,096 slots at least
SLOT_ROWS = 100_000  # rows of a slot that one task ranks


def slot_digits(rows: int) -> int:
    """Leading hex digits of a hash by which so many rows fall into slots of bounded size."""
    digits = SLOT_DIGITS
    while rows > SLOT_ROWS << 4 * digits:
        digits += 1
    return digits


def seeded(key: Sequence[str], seed: int) -> Column:
    """Text whose order is random but repeatable."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def first_n(
    df: DataFrame, n: int, by: Sequence[str], order: Sequence[str | Column], rank: str = "_rank"
) -> DataFrame:
    """The first n rows of every group, with their rank."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def first_n_per_feed(
    df: DataFrame, n: int, order: Sequence[str | Column] = (POSITION,)
) -> DataFrame:
    """The first n rows of every feed in file order."""
    return first_n(df, n, [FEED], order).drop("_rank")


def sample_n(
    df: DataFrame, n: int, by: Sequence[str], key: Sequence[str], seed: int, rank: str = "_rank"
) -> DataFrame:
    """n rows of every group without replacement, in random order of their rank."""
    return (
        first_n(
            df.withColumn("_hash", seeded(key, seed)), n, by, ["_hash", *key], rank
        ).drop("_hash")
    )


def sample_n_per_feed(df: DataFrame, n: int, key: Sequence[str], seed: int) -> DataFrame:
    return sample_n(df, n, [FEED], key, seed).drop("_rank")


def pick_one(
    df: DataFrame,
    first_k: int | None,
    key: Sequence[str],
    seed: int,
    order: Sequence[str | Column] = (POSITION,),
) -> DataFrame:
    """One random row of every feed, among its first k or, without k, among all."""
    rows = df if first_k is None else first_n_per_feed(df, first_k, order)
    return sample_n_per_feed(rows, 1, key, seed)


def pick_routes(
    route_stats: DataFrame,
    n: int = 15,
    seed: int = 42,
    order: Sequence[str | Column] = (POSITION,),
) -> DataFrame:
    """Routes with trips: the n // 2 busiest of a feed, then random others up to n.

    Ranked in ``pick``. Both candidate lists are cut to n rows per feed and task before
    they meet: the n least hashes always hold enough routes outside the busiest. The
    routes are read twice, so give a stored table.
    """
    top = n // 2
    running = route_stats.where("trip_count > 0").withColumn("_hash", seeded(["route_id"], seed))
    busiest = first_n(running, top, [FEED], [F.desc("trip_count"), *order], "_top")
    drawn = first_n(running, n, [FEED], ["_hash", "route_id"], "_draw")
    candidates = busiest.unionByName(drawn, allowMissingColumns=True)
    # a busiest route may also be drawn; it counts once, as busiest
    once = first_n(
        candidates, 1, [FEED, "route_id"], [F.col("_top").asc_nulls_last(), "_draw"], "_seen"
    )
    picked = first_n(once, n, [FEED], [F.col("_top").asc_nulls_last(), "_draw"], "pick")
    return picked.drop("_top", "_draw", "_seen", "_hash")


def top_feeds(
    feed_stats: DataFrame, metric: str, k: int = 5, order: Sequence[str] = (FEED,)
) -> DataFrame:
    """The k feeds with the highest metric, ranked."""
    best = feed_stats.orderBy(F.desc(metric), *order).limit(k)
    # at most k rows
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(metric), *order)))


def last_feed(feed_stats: DataFrame, metric: str) -> DataFrame:
    """The last feed of the ranking by a metric."""
    return feed_stats.orderBy(F.asc(metric), F.desc(FEED)).limit(1)


def best_route(
    route_stats: DataFrame, metric: str, order: Sequence[str | Column] = (POSITION,)
) -> DataFrame:
    """The route with the highest metric of every feed that has more than one route."""
    several = route_stats.groupBy(FEED).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    best = first_n(route_stats, 1, [FEED], [F.col(metric).desc_nulls_last(), *order])
    return best.join(several.select(FEED), FEED, "left_semi").drop("_rank")


def slot_ranks(
    df: DataFrame, key: Sequence[str], seed: int, by: Sequence[str] = ()
) -> DataFrame:
    """Every row with its random rank 1..N (``rank``) inside its group.

    Rows are ranked inside hash slots; the slots' counts give the rank each slot starts from.
    There are more slots for more rows, so no task handles a whole group.
    """
    hashed = df.withColumn("_hash", seeded(key, seed)).withColumn(
        "_slot", F.substring("_hash", 1, slot_digits(df.count()))
    )
    before = Window.partitionBy(*by).orderBy("_slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = hashed.groupBy(*by, "_slot").agg(F.count(F.lit(1)).alias("_size")).select(
        *by, "_slot", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(*by, "_slot").orderBy("_hash", *key)
    return (
        hashed.join(starts, [*by, "_slot"])
        .withColumn("rank", (F.col("_start") + F.row_number().over(inside)).cast("bigint"))
        .drop("_hash", "_slot", "_start")
    )


def shuffled_pairs(feeds: DataFrame, seed: int = 42, columns: Sequence[str] = ()) -> DataFrame:
    """Feeds paired at random, each in one pair; of an odd number one stays alone.

    Columns of the two sides are prefixed ``a_`` and ``b_``.
    """
    ranked = slot_ranks(feeds, [FEED], seed).withColumn(
        "pair", F.expr("(rank - 1) div 2")
    )
    names = columns or feeds.columns

    def side(prefix: str, place: int) -> DataFrame:
        return ranked.where(F.col("rank") % 2 == place).select(
            "pair", *[F.col(c).alias(f"{prefix}_{c}") for c in names]
        )

    return side("a", 1).join(side("b", 0), "pair")


def neighbour_pairs(feeds: DataFrame, n: int = 10, order: Sequence[str] = (FEED,)) -> DataFrame:
    """Each of the first n feeds with its successor, columns prefixed ``a_`` and ``b_``."""
    head = feeds.orderBy(*order).limit(n + 1)
    window = Window.orderBy(*order)  # over n + 1 rows
    own = [F.col(c).alias(f"a_{c}") for c in feeds.columns]
    following = [F.lead(c).over(window).alias(f"b_{c}") for c in feeds.columns]
    return head.select(F.row_number().over(window).alias("pair"), *own, *following).where(
        F.col(f"b_{order[0]}").isNotNull()
    )


def shuffle_rows(df: DataFrame, key: Sequence[str], seed: int = 42) -> DataFrame:
    """All rows in random order (range partitioned, each partition sorted)."""
    return df.orderBy(seeded(key, seed), *key)


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Rows numbered 1..N in the given order, sorted by ranges over many tasks.

    The sorted rows are stored once, because their partitions must not change between
    counting and numbering. One row per partition is summed up.
    """
    placed = materialise(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    offset = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # as many rows as sort partitions
        .withColumn(name, (F.col("_start") + offset + 1).cast("bigint"))
        .drop("_place", "_part", "_start")
    )


def assign_ids(
    items: DataFrame, order: Sequence[str | Column], pattern: str = "BM-%04d", name: str = "id"
) -> DataFrame:
    """Sequence ids in generation order, starting from 1."""
    return number_rows(items, order, "_number").withColumn(
        name, F.format_string(pattern, F.col("_number"))
    ).drop("_number")


def limit_rows(df: DataFrame, n: int, order: Sequence[str] = ("id",)) -> DataFrame:
    """The first n rows; zero means all."""
    return df.orderBy(*order).limit(n) if n > 0 else df


def best_and_worst(
    scored: DataFrame, by: str = "category", score: str = "combined", key: str = "id"
) -> DataFrame:
    """The highest and lowest scored row per category (``which`` says which).

    Equal scores: the first row counts as best, the last as worst. Kept as a running
    minimum and maximum, combined before the shuffle.
    """
    row = F.struct(*[c for c in scored.columns if c != by])
    ends = scored.groupBy(by).agg(
        F.min_by(row, F.struct(-F.col(score), key)).alias("best"),
        F.max_by(row, F.struct(-F.col(score), key)).alias("worst"),
    )
    long = ends.select(
        by,
        F.explode(
            F.array(
                F.struct(F.lit("best").alias("which"), F.col("best").alias("row")),
                F.struct(F.lit("worst").alias("which"), F.col("worst").alias("row")),
            )
        ).alias("end"),
    )
    return long.select(by, "end.which", "end.row.*")


def stratified_split(
    pairs: DataFrame,
    ratio: float = 0.9,
    seed: int = 42,
    key: Sequence[str] | None = None,
    by: str = "category",
) -> DataFrame:
    """Rows marked ``train`` or ``test`` in ``split``, the ratio kept in every category.

    Of n rows int(n * ratio) are for training; if that is all and n >= 2, one moves to
    the test part. ``key`` identifies a row; without it rows count as equal when all
    their columns are, and copies of a row are handled as one row with a weight.

    Only hash slots are counted per category. The rows of the one slot the border falls
    into are ranked, everything else is decided by comparing hashes. What is found per category
    is kept as a small table, so that rows meet it where they are and are not exchanged.
    """
    stratum = F.coalesce(F.col(by), F.lit("unknown"))
    columns = pairs.columns
    if key is None:
        rows = pairs.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
        key = columns
    else:
        rows = pairs.withColumn("_copies", F.lit(1).cast("bigint"))
    # texts of several columns can be equal where the rows are not, see ``seeded``
    told_apart = F.to_json(F.struct(*key)) if len(key) > 1 else F.lit("")
    hashed = (
        rows.withColumn("_stratum", stratum)
        .withColumn("_hash", seeded(key, seed))
        .withColumn("_slot", F.substring("_hash", 1, slot_digits(pairs.count())))
        .withColumn("_key", told_apart)
    )

    per_stratum = Window.partitionBy("_stratum")
    upto = per_stratum.orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    size, wanted = F.col("_n"), F.floor(F.col("_n") * F.lit(ratio)).cast("bigint")
    border = (
        hashed.groupBy("_stratum", "_slot")
        .agg(F.sum("_copies").alias("_size"))
        .select(
            "_stratum",
            "_slot",
            "_size",
            F.sum("_size").over(upto).alias("_upto"),
            F.sum("_size").over(per_stratum).alias("_n"),
        )
        .withColumn(
            "_wanted", F.when((wanted == size) & (size >= 2), wanted - 1).otherwise(wanted)
        )
        .where("_upto >= _wanted and _upto - _size < _wanted")
        .select("_stratum", "_slot", (F.expr("_wanted - (_upto - _size)")).alias("_need"))
    )
    border = kept(border, "border")
    # the rows of one slot per category
    running = per_stratum.orderBy("_hash", "_key").rowsBetween(Window.unboundedPreceding, 0)
    last_train = (
        hashed.join(border, ["_stratum", "_slot"])
        .select(
            "_stratum", "_hash", "_key", "_copies", "_need",
            F.sum("_copies").over(running).alias("_upto"),
        )
        .where("_upto >= _need and _upto - _copies < _need")
        .select(
            "_stratum",
            F.struct("_hash", "_key").alias("_last"),
            F.expr("_need - (_upto - _copies)").alias("_last_copies"),
        )
    )
    last_train = kept(last_train, "last")
    place = F.struct("_hash", "_key")
    marked = hashed.join(last_train, "_stratum", "left").withColumn(
        "_train",
        F.when(place < F.col("_last"), F.col("_copies"))
        .when(place == F.col("_last"), F.col("_last_copies"))
        .otherwise(0),
    )
    parts = marked.select(
        *columns,
        F.explode(
            F.array(
                F.struct(F.lit("train").alias("split"), F.col("_train").alias("copies")),
                F.struct(
                    F.lit("test").alias("split"),
                    (F.col("_copies") - F.col("_train")).alias("copies"),
                ),
            )
        ).alias("_part"),
    ).where("_part.copies > 0")
    parts = parts.select(*columns, "_part.split", F.col("_part.copies").alias("_copies"))
    return parts.drop("_copies") if key is not columns else repeat_rows(parts, "_copies")


def repeat_rows(df: DataFrame, copies: str, chunk: int = 100_000) -> DataFrame:
    """Each row as often as its column ``copies`` says.

    Rows with more than ``chunk`` copies are first cut into chunks that are spread over
    the tasks.
    """
    columns = [c for c in df.columns if c != copies]
    chunks = df.withColumn("_chunk", F.explode(F.expr(f"sequence(0, ({copies} - 1) div {chunk})")))
    left = F.least(F.lit(chunk).cast("bigint"), F.col(copies) - F.col("_chunk") * chunk)
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), left))
    return chunks.hint("rebalance").select(*columns, each.alias("_n")).drop("_n")
