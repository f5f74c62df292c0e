"""Global order with a place for every row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AT, _PART, _BEFORE = "_at", "_part", "_before"


def with_place(
    frame: DataFrame, order: list[Column], keep: Callable[[DataFrame], DataFrame], name: str = "place"
) -> DataFrame:
    """Adds each row's place, from 1, in the order given.

    Rows are dealt by ranges of the order and sorted there; a row's place is its number inside its range and
    the counts of the ranges before. Only those counts, one number a partition, meet in one task. ``keep``
    holds the sorted rows for both readers, so that both see the same ranges.
    """
    rows = keep(frame.orderBy(*order).withColumn(_AT, F.monotonically_increasing_id()))
    rows = rows.withColumn(_PART, F.shiftright(_AT, 33))
    counts = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = F.sum("_rows").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(_PART, F.coalesce(earlier, F.lit(0)).alias(_BEFORE))
    inside = F.col(_AT).bitwiseAND(F.lit((1 << 33) - 1))
    placed = rows.join(offsets, _PART).withColumn(name, F.col(_BEFORE) + inside + 1)
    return placed.drop(_AT, _PART, _BEFORE)
