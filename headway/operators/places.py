"""Stops near stops."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH = 6_371_000.0  # mean radius in metres
DENSE = 2000  # stops of a cell that one task compares at once


def distance(lat: Column, lon: Column, other_lat: Column, other_lon: Column) -> Column:
    """Great-circle distance in metres; NULL if a position is."""
    a, b = F.radians(lat), F.radians(other_lat)
    across = F.sin((b - a) / 2) ** 2 + F.cos(a) * F.cos(b) * F.sin((F.radians(other_lon) - F.radians(lon)) / 2) ** 2
    # rounding may lead above 1; not by F.least, which would take 1 for an unknown position
    return 2 * EARTH * F.asin(F.sqrt(F.when(across > 1, 1.0).otherwise(across)))


def _row(lat: Column, step: float) -> Column:
    return F.floor(lat / step).cast("bigint")


def _columns_of_row(row: Column, step: float) -> Column:
    """How many cells go around the globe in a row: each as wide as a circle of radius ``step``
    around a point of the row reaches on either side, even at the edge nearer to a pole."""
    edge = F.least(F.greatest(F.abs(row * step), F.abs((row + 1) * step)), F.lit(90.0))
    ratio = math.sin(math.radians(step)) / F.cos(F.radians(edge))
    reach = F.degrees(F.asin(F.least(ratio, F.lit(1.0))))
    return F.when(ratio < 1, F.floor(360.0 / reach)).otherwise(1).cast("bigint")


def _column(lon: Column, columns: Column) -> Column:
    return F.pmod(F.floor((lon + 180) / 360.0 * columns).cast("bigint"), columns)


def _reach(columns: Column, column: Column) -> Column:
    """A cell of a row and those beside it, around the globe, each once."""
    all_cells = F.sequence(F.lit(0).cast("bigint"), columns - 1)
    three = F.array(*[F.pmod(column + i, columns) for i in (-1, 0, 1)])
    return F.when(columns <= 3, all_cells).otherwise(three)


def near_stops(
    stops: DataFrame,
    metres: float,
    by: Sequence[str] = ("feed_id",),
    identity: str = "stop_id",
    dense: int = DENSE,
    prefix: str = "other_",
) -> DataFrame:
    """Pairs of stops of a key at most ``metres`` apart: key, the smaller identity, the other
    with ``prefix``, and ``metres``. Stops without a valid position have no neighbours.

    Every stop lies in a cell of a grid of rows that are ``metres`` high, with cells
    at least as wide, and is compared with the stops of its cell and the eight around it; cells wrap
    around the globe and widen towards the poles. A cell of more than ``dense`` stops is dealt
    out over several groups, each of which meets all stops around, so that a crowded place is
    shared by tasks.
    """
    by = list(by)
    step = math.degrees(metres / EARTH) * 1.000001
    valid = (
        F.col("stop_lat").between(-90, 90) & F.col("stop_lon").between(-180, 180)
        & F.col(identity).isNotNull()
    )
    placed = (
        stops.where(valid).select(*by, identity, "stop_lat", "stop_lon")
        .withColumn("_row", _row(F.col("stop_lat"), step))
        .withColumn("_column", _column(F.col("stop_lon"), _columns_of_row(F.col("_row"), step)))
    )
    cell = [*by, "_row", "_column"]
    crowded = placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / F.lit(dense)).cast("int").alias("_parts"))
    crowded = crowded.where("_parts > 1")
    part = F.pmod(F.xxhash64(identity), F.coalesce("_parts", F.lit(1))).cast("int")
    own = placed.join(crowded, cell, "left").withColumn("_part", part).drop("_parts")
    around = placed.withColumn("_row", F.explode(F.array(*[F.col("_row") + i for i in (-1, 0, 1)])))
    columns = _columns_of_row(F.col("_row"), step)
    around = around.withColumn("_column", F.explode(_reach(columns, _column(F.col("stop_lon"), columns))))
    others = (
        around.join(crowded, cell, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .select(
            *cell, "_part",
            *[F.col(c).alias(f"{prefix}{c}") for c in (identity, "stop_lat", "stop_lon")],
        )
    )
    pairs = own.join(others, [*cell, "_part"]).where(F.col(identity) < F.col(f"{prefix}{identity}"))
    apart = distance(
        F.col("stop_lat"), F.col("stop_lon"), F.col(f"{prefix}stop_lat"), F.col(f"{prefix}stop_lon")
    )
    return pairs.withColumn("metres", apart).where(F.col("metres") <= metres).select(
        *by, identity, f"{prefix}{identity}", "metres"
    )
