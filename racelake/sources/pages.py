"""Stored pages and the lookup of the pages a session plan asks for.

A page store has ``page_id`` (unique), ``url``, ``html`` and ``scraped_at_utc``, and may hold
several copies of a URL, of which the newest counts. As a table of the catalog, bucketed by URL (``store``), it is
never shuffled again: every look-up deals its plan out to the buckets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.sources import html
from racelake.sources.staging import writing

NOT_STORED = "no page stored for this URL"


def store(pages: DataFrame, name: str, buckets: int | None = None) -> DataFrame:
    """Pages as a table bucketed by URL, one file a bucket.

    The default is a bucket per shuffle partition: fewer than a join's partitions would make Spark deal the pages out anew.
    The pages of a bucket are not sorted: a join sorts what it reads in any case.
    """
    buckets = buckets or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pages.repartition(buckets, "url")
    with writing(pages.sparkSession):
        dealt.write.bucketBy(buckets, "url").option("compression", "zstd").saveAsTable(name)
    return pages.sparkSession.table(name)


def newest_copies(plan: DataFrame, pages: DataFrame) -> DataFrame:
    """The plan with the ``page_id`` of the newest stored copy of its ``page_url``, null without one.

    Reads only the narrow columns of the store; copies of a URL are reduced on the map side. A plan is derived from
    other tables, so its size is a guess (three rows of a plan may count as one, and as long as in a compressed file): the
    join is a merge join, since a broadcast upon that guess would bring a plan as long as the store to the driver.
    """
    narrow = pages.select(F.col("url").alias("page_url"), "scraped_at_utc", "page_id")
    newest = narrow.groupBy("page_url").agg(F.max(F.struct("scraped_at_utc", "page_id")).alias("_newest"))
    found = plan.join(newest.hint("merge"), "page_url", "left")
    return found.select(*plan.columns, F.col("_newest.page_id").alias("page_id"))


def read_pages(
    plan: DataFrame, pages: DataFrame, derive: dict[str, Callable[[Column], Column]], with_links: bool = False,
    with_missing: bool = True,
) -> DataFrame:
    """Plan rows with the tables of their page; rows whose page is missing say so in ``error``, or are left out.

    ``derive`` adds columns computed from the markup. The markup itself is only joined to the list of
    wanted page ids: it stays where it is read while that list is small enough to broadcast, and
    moves once, by a key without repeats, when it is not. What follows needs no shuffle.
    """
    wanted = newest_copies(plan, pages)
    stored = pages.select("page_id", "html", "scraped_at_utc").join(wanted.filter(F.col("page_id").isNotNull()), "page_id")
    described = stored.withColumns({name: rule(F.col("html")) for name, rule in derive.items()})
    keep = [*plan.columns, "scraped_at_utc", *derive]
    read = html.extract_tables(described, keep, with_links)
    if not with_missing:
        return read
    missing = wanted.filter(F.col("page_id").isNull()).select(*plan.columns, F.lit(NOT_STORED).alias("error"))
    return read.unionByName(missing, allowMissingColumns=True)


def read_stored(
    plan: DataFrame, stored: DataFrame, derive: dict[str, Callable[[Column], Column]], with_links: bool = False
) -> DataFrame:
    """As ``read_pages``, on a store bucketed by URL: the plan is evaluated once and markup is not moved.

    Both look-ups, of the newest copy's id and of its markup, are joins on the URL alone, so they use the buckets; the
    id is compared as a range because another equality would ask for another distribution.
    """
    narrow = stored.select(F.col("url").alias("page_url"), "scraped_at_utc", "page_id")
    newest = narrow.groupBy("page_url").agg(F.max(F.struct("scraped_at_utc", "page_id")).alias("_newest"))
    wanted = plan.join(newest, "page_url", "left").withColumn("_wanted", F.col("_newest.page_id")).drop("_newest")
    copies = stored.select(F.col("url").alias("_url"), "page_id", "html", "scraped_at_utc")
    same = (F.col("page_url") == F.col("_url")) & F.col("page_id").between(F.col("_wanted"), F.col("_wanted"))
    met = wanted.join(copies, same, "left").drop("_url", "_wanted")
    described = met.withColumns({name: rule(F.col("html")) for name, rule in derive.items()})
    keep = [*plan.columns, "scraped_at_utc", *derive]
    read = html.extract_tables(described.withColumn("_stored", F.col("page_id").isNotNull()), [*keep, "_stored"], with_links)
    return read.select(
        *keep, F.when(F.col("_stored"), F.col("tables")).alias("tables"),
        F.when(F.col("_stored"), F.col("error")).otherwise(NOT_STORED).alias("error"),
    )
