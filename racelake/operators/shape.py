"""Projections, schema changes, row splits and unions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.fixed import BOILERPLATE_NOTE, BROKEN_NOTE
from racelake.functions import text
from racelake.schemas import NUMERIC, fields


def rename(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Keep, order and rename columns by a ``source -> target`` mapping."""
    return df.select(*(F.col(source).alias(target) for source, target in columns.items()))


def cast_to(df: DataFrame, schema: str) -> DataFrame:
    """The schema's columns, each cast to its type; values that do not fit become null."""
    return df.select(*(F.col(name).try_cast(kind).alias(name) for name, kind in fields(schema)))


def conform(df: DataFrame, schema: str) -> DataFrame:
    """A loose table in exactly the schema's columns.

    Missing columns come as null, extra ones go, dirty numbers become null and everything that
    is not a number becomes text (or the schema's own type). Names are matched as spelt.
    """
    present = dict(df.dtypes)

    def one(name: str, kind: str) -> Column:
        if name not in present:
            return F.lit(None).cast(kind)
        if present[name] == kind:
            return F.col(name)
        if kind in NUMERIC and present[name] == "string":
            return text.number(F.col(name), kind)
        return F.col(name).try_cast(kind)

    return df.select(*(one(name, kind).alias(name) for name, kind in fields(schema)))


def split_rows(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows for which the condition is true, and all others (null counts as not true)."""
    return df.filter(condition), df.filter(~F.coalesce(condition, F.lit(False)))


def notes(df: DataFrame, marker: str, event: str, drop_broken: bool = False) -> DataFrame:
    """The footnote rows of a result table: rows whose marker column is null, tagged by event.

    The boilerplate note and rows without driver text are dropped.
    """
    kept = F.col(marker).isNull() & (F.col("driver") != BOILERPLATE_NOTE)
    if drop_broken:
        kept = kept & ~F.contains(F.col("driver"), F.lit(BROKEN_NOTE))
    return df.filter(kept).select(
        text.without_stars(F.col("driver_name")).alias("Note"),
        F.col("race_id").alias("Race_Id"),
        F.col("season").alias("Season"),
        F.col("gp_slug").alias("Gp_Slug"),
        F.lit(event).alias("Event"),
    )


def union_all(tables: Iterable[DataFrame]) -> DataFrame:
    """Tables below each other by column name; a column some of them lack is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def practices(sessions: Mapping[int, DataFrame]) -> DataFrame:
    """The practice tables of a weekend as one, numbered and labelled by session."""
    numbered = union_all(df.withColumn("practice_no", F.lit(n)) for n, df in sessions.items())
    return numbered.withColumn("Practice", text.label("Practice", F.col("practice_no")))
