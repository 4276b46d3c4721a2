"""Joins by order: the nearest row in time, points in intervals, overlapping intervals.

Spark joins by equality; these operators add an equality that keeps the work local. Time is cut
into buckets of a given width, so one key may hold a third of all rows and still be spread over
as many tasks as it has buckets. Nothing is broadcast and no pair is made that its bucket
does not hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEFT, RIGHT = 0, 1


def _bucket(time: Column, width: int) -> Column:
    return F.floor(time / F.lit(width)).cast("bigint")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    width: int,
    values: Sequence[str],
    direction: str = "forward",
    exact: bool = True,
    within: int | None = None,
    prefix: str = "next_",
    links: DataFrame | None = None,
    on: Sequence[str] = (),
    delays: str = "delays",
) -> DataFrame:
    """Every left row with the values of the nearest right row of its key in time.

    ``forward`` takes the first right row at or behind the left one's time, ``backward`` the
    last at or before it; without ``exact`` the times must differ, and ``within`` bounds the
    difference. Of right rows at the same time the first by ``values`` counts. The matched time
    is ``<prefix><right_time>``, the values ``<prefix><value>``; without a match they are NULL,
    as they are for left rows without a time or with a NULL in the key. Right rows
    without a time match nothing.

    Both sides are united and read in order of time once, in buckets of ``width``. What a
    bucket needs from further ones is one row, carried over from its key's buckets.

    With ``links`` a left row asks at all right keys that it is linked with by the columns ``on``;
    its time and the link's ``delays`` are arrays, and it asks at each sum of both. A row per left row
    and link comes back: the times asked at, and beside them what was found, as arrays. The
    pairs are never exchanged or sorted: each link carries the different times of its right
    key in order, so these must be of a bounded kind, as times of day are.
    """
    if direction not in ("forward", "backward"):
        raise ValueError(f"unknown direction {direction}")
    forward = direction == "forward"
    by = list(by)
    if links is not None:
        timetable = _timetable(right, by, right_time, values)
        pairs = left.join(links.join(timetable, by, "left"), list(on))
        return _asked(pairs, left_time, delays, right_time, values, forward, exact, within, prefix)
    right_key = F.lit(True)
    for c in by:
        right_key = right_key & F.col(c).isNotNull()
    match = F.struct(F.col(right_time).alias("time"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    timed = right.where(F.col(right_time).isNotNull() & right_key)
    events = timed.select(
        *by, F.col(right_time).alias("_time"), F.lit(RIGHT).alias("_side"), match.alias("_match"),
        F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"),
    )
    # equal times: the wanted one of the right rows is the last that is read
    nothing = F.lit(None).cast(events.schema["_match"].dataType)
    asked = left.select(
        *by, F.col(left_time).alias("_time"), F.lit(LEFT).alias("_side"), nothing.alias("_match"),
        F.struct("*").alias("_row"),
    )
    bucket = _bucket(F.col("_time"), width)
    usable = F.col("_time").isNotNull() & right_key
    # rows that match nothing are spread, however many they are
    spread = -(1 << 40) - F.pmod(F.xxhash64("_row"), F.lit(4096))
    events = events.withColumn("_bucket", bucket)
    asked = asked.withColumn("_bucket", F.when(usable, bucket).otherwise(spread))

    # per bucket the right row that other buckets would take, and the buckets that ask
    edge = F.min("_match") if forward else _last_match(values)
    held = events.groupBy(*by, "_bucket").agg(edge.alias("_edge"))
    asking = asked.where(usable).select(*by, "_bucket").distinct()
    buckets = (
        held.select(*by, "_bucket", "_edge", F.lit(False).alias("_asks"))
        .unionByName(asking.select(*by, "_bucket", F.lit(None).cast(held.schema["_edge"].dataType).alias("_edge"),
                                   F.lit(True).alias("_asks")))
        .groupBy(*by, "_bucket").agg(F.first("_edge", True).alias("_edge"), F.max("_asks").alias("_asks"))
    )
    order = F.col("_bucket").desc() if forward else F.col("_bucket").asc()
    beyond = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.withColumn("_match", F.last("_edge", True).over(beyond)).where("_asks and _match is not null")
    edge_time = (F.col("_bucket") + 1) * width if forward else F.col("_bucket") * width - 1
    sentinels = carried.select(
        *by, edge_time.cast(asked.schema["_time"].dataType).alias("_time"), F.lit(RIGHT).alias("_side"), "_match",
        F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"), "_bucket",
    )
    rows = asked.unionByName(events).unionByName(sentinels)
    side = F.col("_side").desc() if exact else F.col("_side").asc()
    if forward:
        sort = [F.col("_time").desc(), side, F.col("_match").desc()]
    else:
        sort = [F.col("_time").asc(), side, *[F.col(f"_match.v{i}").desc() for i in range(len(values))]]
    running = Window.partitionBy(*by, "_bucket").orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_found", F.last("_match", True).over(running)).where(F.col("_side") == LEFT)
    if within is not None:
        usable = usable & (F.abs(F.col("_found.time") - F.col("_time")) <= within)
    result = F.when(usable, F.col("_found"))
    return found.select(
        "_row.*", result["time"].alias(f"{prefix}{right_time}"),
        *[result[f"v{i}"].alias(f"{prefix}{c}") for i, c in enumerate(values)],
    )


def _timetable(right: DataFrame, by: Sequence[str], time: str, values: Sequence[str]) -> DataFrame:
    """Per key its different times in order, the first values of each, and the powers of two up to
    their number, from the largest."""
    known = right.where(F.col(time).isNotNull()).na.drop(subset=list(by))
    match = F.struct(F.col(time).alias("time"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    firsts = known.groupBy(*by, F.col(time).alias("_time")).agg(F.min(match).alias("_match"))
    kept = [] if not values else [F.sort_array(F.collect_list("_match")).alias("_matches")]
    sorted_times = firsts.groupBy(*by).agg(F.sort_array(F.collect_list("_time")).alias("_times"), *kept)
    exponents = F.sequence(F.floor(F.log2(F.size("_times"))).cast("int"), F.lit(0), F.lit(-1))
    return sorted_times.withColumn("_powers", F.transform(exponents, lambda k: F.pow(F.lit(2), k).cast("int")))


def _asked(
    pairs: DataFrame, left_time: str, delays: str, right_time: str, values: Sequence[str], forward: bool,
    exact: bool, within: int | None, prefix: str,
) -> DataFrame:
    """What each pair of a left row and a link finds in the link's timetable, by binary search."""
    asked = F.flatten(F.transform(left_time, lambda t: F.transform(delays, lambda d: t + d)))

    def place(t: Column) -> Column:
        """How many times lie before the wanted one."""
        def before(c: Column) -> Column:
            return c < t if forward == exact else c <= t

        count = F.aggregate(
            "_powers", F.lit(0),
            lambda n, p: F.when(before(F.get("_times", n + p - 1)), n + p).otherwise(n),
        )
        return count if forward else count - 1

    def found(source: str, t: Column, at: Column) -> Column:
        fits = t.isNotNull()
        if within is not None:
            fits = fits & (F.abs(F.get("_times", at) - t) <= within)
        return F.when(fits, F.get(source, at))

    placed = pairs.withColumn(left_time, asked).withColumn("_places", F.transform(left_time, place))
    result = {right_time: F.zip_with(left_time, "_places", lambda t, at: found("_times", t, at))}
    for i, c in enumerate(values):
        result[c] = F.zip_with(left_time, "_places", lambda t, at: found("_matches", t, at)[f"v{i}"])
    return placed.select("*", *[v.alias(f"{prefix}{c}") for c, v in result.items()]).drop(
        "_times", "_matches", "_powers", "_places", delays
    )


def merged_intervals(intervals: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """The union of the intervals [start, end) of each key, as intervals that lie apart."""
    by = list(by)
    line = Window.partitionBy(*by).orderBy(start, end)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col(start) > F.max(end).over(before), F.lit(True)).cast("int")
    islands = intervals.where(F.col(start) < F.col(end)).select(*by, start, end).withColumn("_apart", apart)
    numbered = islands.withColumn("_island", F.sum("_apart").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def _last_match(values: Sequence[str]) -> Column:
    """Of the latest right rows the first by their values."""
    order = F.struct((-F.col("_time")).alias("t"), *[F.col(f"_match.v{i}") for i in range(len(values))])
    return F.min_by("_match", order)


def _bins(start: Column, end: Column, width: int) -> Column:
    return F.sequence(_bucket(start, width), _bucket(end, width))


def points_in_intervals(
    points: DataFrame,
    intervals: DataFrame,
    by: Sequence[str],
    point: str,
    start: str,
    end: str,
    width: int,
) -> DataFrame:
    """Pairs of a point and an interval [start, end) of its key that holds it.

    An interval is entered into every bin of ``width`` that it touches, a point into its
    own, so each pair is found once. Intervals that end before they start hold nothing. Other
    columns of both sides must differ in name.
    """
    by = list(by)
    binned = intervals.where(F.col(start) < F.col(end)).withColumn(
        "_bin", F.explode(_bins(F.col(start), F.col(end) - 1, width))
    )
    placed = points.withColumn("_bin", _bucket(F.col(point), width))
    pairs = placed.join(binned, [*by, "_bin"])
    return pairs.where((F.col(point) >= F.col(start)) & (F.col(point) < F.col(end))).drop("_bin")


def overlapping_intervals(
    intervals: DataFrame,
    by: Sequence[str],
    identity: str,
    start: str,
    end: str,
    width: int,
    prefix: str = "other_",
) -> DataFrame:
    """Pairs of intervals [start, end) of a key that share time, each pair once: the smaller
    identity first, the other with ``prefix``, and ``overlap``.

    Both sides are entered into the bins they touch; a pair counts in the first bin that
    both touch, so it is found once without a distinct.
    """
    by = list(by)
    kept = intervals.where(F.col(start) < F.col(end)).select(*by, identity, start, end)
    first = _bucket(F.col(start), width)
    binned = kept.withColumn("_first", first).withColumn(
        "_bin", F.explode(_bins(F.col(start), F.col(end) - 1, width))
    )
    other = binned.select(
        *by, "_bin", F.col("_first").alias("_other_first"),
        *[F.col(c).alias(f"{prefix}{c}") for c in (identity, start, end)],
    )
    pairs = binned.join(other, [*by, "_bin"]).where(
        (F.col("_bin") == F.greatest("_first", "_other_first"))
        & (F.col(identity) < F.col(f"{prefix}{identity}"))
        & (F.col(start) < F.col(f"{prefix}{end}"))
        & (F.col(f"{prefix}{start}") < F.col(end))
    )
    overlap = F.least(end, f"{prefix}{end}") - F.greatest(start, f"{prefix}{start}")
    return pairs.withColumn("overlap", overlap).drop("_bin", "_first", "_other_first")
