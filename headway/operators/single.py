"""Results of one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The columns of several one-row results in one row.

    The others are read as scalar subqueries, so nothing is joined.
    """
    row = first
    for i, other in enumerate(others):
        row = row.withColumn(f"_{i}", other.select(F.struct(*other.columns)).scalar())
    found = [F.col(f"_{i}.{c}") for i, other in enumerate(others) for c in other.columns]
    return row.select(*first.columns, *found)
