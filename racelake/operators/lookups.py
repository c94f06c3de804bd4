"""Joins: attach one row per key, carry flags, keep new rows, star joins.

No join here carries a broadcast hint. Spark broadcasts a side only when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` (checked on the files and again on the shuffled
bytes at run time); beyond that both sides are shuffled and adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.functions import rules

SALTS = 1


def _spread_join(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str, spread: Sequence[str], null_safe: bool, salts: int
) -> DataFrame:
    """Join rows to a table with one row per key so that no key has to fit in one task.

    The other table is shuffled by key *and* salt, not just grouped by key, so both join inputs are plain
    shuffles, which is what adaptive execution needs to split a partition that is too large by its size.
    With ``salts`` over one, the rows of a key are also spread over that many partitions by a hash of the
    ``spread`` columns, and the one row of the other table is repeated for each. The salt depends on
    these columns alone (the key's by default): filters on the result reach the scans, and no other column is read for it.
    """
    if salts > 1 and not spread:
        raise ValueError("name the columns that tell the rows of a key apart")
    salt = F.pmod(F.xxhash64(*(spread if salts > 1 else keys)), F.lit(salts)).cast("int")
    left = rows.withColumn("_salt", salt)
    right = per_key.select(
        *(F.col(k).alias(f"_key_{k}") for k in keys),
        *(c for c in per_key.columns if c not in keys),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_key_salt"),
    )

    def same(k: str) -> Column:
        mine, theirs = F.col(k), F.col(f"_key_{k}")
        return mine.eqNullSafe(theirs) if null_safe else mine == theirs

    on = reduce(and_, map(same, keys), F.col("_salt") == F.col("_key_salt"))
    return left.join(right, on, how).drop("_salt", "_key_salt", *(f"_key_{k}" for k in keys))


def attach(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], spread: Sequence[str] = (),
    null_safe: bool = False, salts: int = SALTS,
) -> DataFrame:
    """All rows with the columns of a summary that has one row per key."""
    return _spread_join(rows, per_key, keys, "left", spread, null_safe, salts)


def having(
    rows: DataFrame, listed: DataFrame, keys: Sequence[str], null_safe: bool = False, spread: Sequence[str] = ()
) -> DataFrame:
    """The rows whose key is listed."""
    return _spread_join(rows, listed.select(*keys).distinct(), keys, "left_semi", spread, null_safe, SALTS)


def lacking(
    rows: DataFrame, listed: DataFrame, keys: Sequence[str], null_safe: bool = False, spread: Sequence[str] = ()
) -> DataFrame:
    """The rows whose key is not listed."""
    return _spread_join(rows, listed.select(*keys).distinct(), keys, "left_anti", spread, null_safe, SALTS)


def carry_flag(rows: DataFrame, known: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Rows with the processing flag of the known table: ``Y`` where a known row has it, else ``N``."""
    done = known.groupBy(*keys).agg(F.max(F.when(F.col(flag) == "Y", "Y")).alias("_done"))
    carried = attach(rows.drop(flag), done, keys)
    return carried.withColumn(flag, rules.kept_flag(F.col("_done"))).drop("_done")


def unseen(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the known table lacks (null keys compare equal).

    The known table may be far larger than the rows: it is first cut down to the rows' own keys,
    by a broadcast of these while they are small and by one shuffle of its key columns otherwise.
    """
    present = having(known.select(*keys), rows, keys, null_safe=True)
    return lacking(rows, present, keys, null_safe=True)


def unprocessed(rows: DataFrame, known: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Rows whose key is not yet flagged ``Y`` in the known table."""
    return lacking(rows, known.filter(F.col(flag) == "Y"), keys)


class Registered(NamedTuple):
    """What registering a season yields."""

    staged: DataFrame
    """every staged race with its carried flag"""
    pending: DataFrame
    """races still to be processed"""
    to_append: DataFrame
    """pending races the master table does not list yet, each once"""


def register_races(staged: DataFrame, known: DataFrame, season: int | None = None) -> Registered:
    """Compare the staged races of a season with the master table.

    Running it twice appends nothing twice: a pending race that is already listed is not appended
    again.
    """
    keys = ["season", "gp"]
    if season is not None:
        staged, known = staged.filter(F.col("season") == season), known.filter(F.col("season") == season)
    columns = staged.columns
    flagged = carry_flag(staged, known, keys, "bronze").withColumn("silver", F.lit("N")).select(*columns)
    pending = flagged.filter(F.col("bronze") == "N")
    new = unseen(pending, known, keys)
    # of a race staged several times the newest row; rows of the same time by their other columns
    order = sorted((c for c in columns if c not in keys), key=lambda c: c != "scraped_at_utc")
    once = new.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_row")).select(*keys, "_row.*").select(*columns)
    return Registered(flagged, pending, once)


def promote(staging: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The staging rows to append to the base table: those whose key it does not hold yet.

    ``keys`` name what is loaded as a whole (a race, a race and session), so all rows of a new key
    come along and a second run appends nothing.
    """
    return unseen(staging, base, keys)


def star(fact: DataFrame, *dimensions: tuple[DataFrame, str]) -> DataFrame:
    """Fact rows with their dimension rows, joined many-to-one on the named keys."""
    return reduce(lambda rows, dim: rows.join(dim[0], dim[1], "left"), dimensions, fact)
