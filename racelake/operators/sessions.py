"""Values relative to the leader of a session or the winner of a race.

The groups are summed up first (partial aggregates on the map side) and the result is joined
back, so that no single task ever holds a whole group, as a window would need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.functions import durations, text
from racelake.operators.lookups import attach


def leader_value(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, spread: Sequence[str]
) -> DataFrame:
    """The first value that is not null in each group, by ``order`` (nulls last), on every row."""
    rank = [x for c in order for x in (F.col(c).isNull().alias(f"{c}_missing"), F.col(c))]
    first = F.min(F.when(F.col(value).isNotNull(), F.struct(*rank, F.col(value).alias("_value"))))
    leaders = rows.groupBy(*keys).agg(first.alias("_first")).select(*keys, F.col("_first._value").alias(name))
    return attach(rows, leaders, keys, spread, null_safe=True)


def leader_times(rows: DataFrame, strict: bool = False) -> DataFrame:
    """Practice rows with the leader's time of their session and their own, leader plus gap."""
    timed = leader_value(
        rows, ["race_id", "practice_no"], ["position"], "time_s", "base_time_s", ["position", "car_number"]
    )
    return timed.withColumn(
        "real_time_s", durations.from_leader(F.col("base_time_s"), F.col("gap_s"), strict)
    )


def winner_gaps(
    rows: DataFrame, keys: Sequence[str], position: str, time_text: str, order: str
) -> DataFrame:
    """Rows with ``race_time_s`` on the race's winner and ``gap_to_winner_s`` on the others.

    The winner is the first row in position 1 by ``order`` (a number, unique within the race).
    Gaps are read only from texts with a leading ``+``, and only in races that have a winner.
    """
    won = F.min(F.when(F.col(position) == 1, F.col(order))).alias("_winner")
    winners = rows.groupBy(*keys).agg(won).filter(F.col("_winner").isNotNull())
    joined = attach(rows, winners, keys, [order], null_safe=True)
    return with_winner_gaps(
        joined, F.col(order) == F.col("_winner"), F.col("_winner").isNotNull(), time_text
    ).drop("_winner")


def with_winner_gaps(rows: DataFrame, is_winner: Column, has_winner: Column, time_text: str) -> DataFrame:
    """Add the two winner-relative columns, given who won."""
    timed = rows.withColumn("_secs", durations.seconds(F.col(time_text)))
    gap = has_winner & ~is_winner & text.is_gap(F.col(time_text))
    return timed.withColumns(
        {"race_time_s": F.when(is_winner, F.col("_secs")), "gap_to_winner_s": F.when(gap, F.col("_secs"))}
    ).drop("_secs")
