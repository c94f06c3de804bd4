"""Conditions on partition columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def partition_values(rows: DataFrame, by: Sequence[str]) -> list[Row]:
    """The partitions that some rows belong to."""
    return rows.select(*by).distinct().collect()


def in_partitions(by: Sequence[str], values: Sequence[Row]) -> Column:
    """A condition on partition columns alone, with literals: the scan lists and reads these partitions only."""
    if len(by) == 1:
        listed = [v[0] for v in values if v[0] is not None]
        known = F.col(by[0]).isin(*listed) if listed else F.lit(False)
        return known if len(listed) == len(values) else known | F.col(by[0]).isNull()
    one = (reduce(and_, (F.col(c).eqNullSafe(F.lit(x)) for c, x in zip(by, v))) for v in values)
    return reduce(or_, one, F.lit(False))
