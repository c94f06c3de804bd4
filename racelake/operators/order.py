"""Ordered results with the place of every row, at any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.sources.staging import staged

_RANGE_BITS = 33
"""``monotonically_increasing_id`` keeps the partition above these bits and the row below them"""


def with_position(rows: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """``rows`` in order, with their place from 1 in a column of the given name.

    Rows are dealt out in sorted ranges, as many as the sort has partitions, and written once, so that both
    passes see the same ranges; a range's first place is the number of rows in the ranges before it. To the driver
    comes one count per range. Rows that the order does not tell apart get their places as they come.
    """
    numbered = staged(rows.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()), "ordered")
    in_range = F.shiftright("_row", _RANGE_BITS).cast("int")
    counts = dict(numbered.groupBy(in_range.alias("part")).count().collect())
    before, total = [], 0
    for part in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(part, 0)
    first = F.element_at(F.array(*map(F.lit, before or [0])).cast("array<bigint>"), in_range + 1)
    row = F.col("_row") - F.shiftleft(in_range.cast("long"), _RANGE_BITS)
    return numbered.withColumn(name, first + row + 1).drop("_row").orderBy(name)
