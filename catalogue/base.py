"""Registration of queries and access to the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder; ``t.orders`` is a DataFrame, ``t(sql)`` a query over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __call__(self, sql: str, spread: bool = False) -> DataFrame:
        """A query over the tables; with ``spread`` their rows are dealt out by their key first.

        That is for queries that make much work of every row: the size of a file then does not decide
        how many tasks share it.
        """
        used = {name: getattr(self, name) for name in TABLES if "{" + name + "}" in sql}
        return self.spark.sql(sql, **{name: df.repartition(df[df.columns[0]]) if spread else df for name, df in used.items()})


def duck(sql: str) -> str:
    """A derivation as DuckDB reads it: table names in place of the marks."""
    for name in TABLES:
        sql = sql.replace("{" + name + "}", name)
    return sql


def query(name: str, sql: str | None = None, **sources: str):
    """Register a query; ``sources`` are derivations that the SQL names as tables."""

    def register(run: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: run(Tables(spark, folder))
        if sql is not None:
            parts = [f"{alias} AS ({duck(text)})" for alias, text in sources.items()]
            ORACLES[name] = ("WITH " + ", ".join(parts) + " " if parts else "") + sql
        return run

    return register
