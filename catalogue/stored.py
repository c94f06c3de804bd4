"""Stored tables: written, changed in place, read back; versions, promotion, run log, evolving schemas, numbered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.base import Tables, query
from catalogue.changes import ORDERS, SNAPSHOT_ROWS, STAMPS
from racelake.operators import shape
from racelake.operators.snapshots import VERSION
from racelake.sources import generations, staging, stored, tables, versions

c = F.col

SEASONAL_ORDERS = "SELECT CAST(o_orderkey AS INT) AS race_id, o_orderstatus, o_totalprice, CAST(1992 + o_orderkey % 7 AS INT) AS season FROM {orders}"
SEASONAL_LINES = """
SELECT CAST(l_orderkey AS INT) AS race_id, CAST(l_linenumber AS INT) AS line, l_partkey, CAST(l_linenumber AS STRING) AS position,
       CASE WHEN l_quantity > 48 THEN NULL ELSE l_quantity END AS points, CASE WHEN l_linestatus = 'F' THEN 'Finished' ELSE 'DNF' END AS status,
       CASE WHEN l_quantity < 10 THEN NULL ELSE CAST(l_quantity AS INT) END AS laps,
       CASE WHEN l_linenumber IN (2, 5) AND l_orderkey % 7 < 4 THEN NULL ELSE 'OK' END AS time_or_retired,
       CAST(1992 + l_orderkey % 7 AS INT) AS season
FROM {lineitem}
"""


def _table(t: Tables, sql: str, name: str) -> str:
    """The rows as a table of the catalog, a partition a season."""
    name = staging.table_name(name)
    stored.create(t(sql), name, ["season"])
    return name


@query(
    "update_stored",
    """
    SELECT * REPLACE (CASE WHEN flag <> '1-URGENT' AND season IN (1994, 1997) THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                      CASE WHEN flag <> '1-URGENT' AND season IN (1994, 1997) THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice)
    FROM src
    """,
    src=ORDERS,
)
def update_stored(t: Tables):
    """Two columns of two seasons set; the other seasons' files stay."""
    name = _table(t, ORDERS, "orders")
    hit = (c("flag") != "1-URGENT") & c("season").isin(1994, 1997)
    stored.update(t.spark, name, hit, {"o_orderstatus": F.lit("X"), "o_totalprice": c("o_totalprice") * 2})
    return t.spark.table(name)


@query(
    "delete_stored",
    "SELECT * FROM src WHERE NOT coalesce(season = 1993 OR (season = 1996 AND flag = '2-HIGH'), false)",
    src=ORDERS,
)
def delete_stored(t: Tables):
    """One season emptied, another one thinned out."""
    name = _table(t, ORDERS, "orders")
    stored.delete(t.spark, name, (c("season") == 1993) | ((c("season") == 1996) & (c("flag") == "2-HIGH")))
    return t.spark.table(name)


_DOOMED = "race_id % 7 = 3 OR (race_id % 7 = 5 AND race_id IN (SELECT CAST(o_orderkey AS INTEGER) FROM orders WHERE o_orderstatus = 'F'))"


@query(
    "delete_keys_stored",
    f"""
    SELECT 'orders' AS name, race_id, season, CAST(0 AS INTEGER) AS line FROM o WHERE NOT ({_DOOMED})
    UNION ALL SELECT 'lineitem', race_id, season, line FROM l WHERE NOT ({_DOOMED})
    """,
    o=SEASONAL_ORDERS, l=SEASONAL_LINES,
)
def delete_keys_stored(t: Tables):
    """The same races deleted from two tables: a whole season of both, a part of another one."""
    names = {"orders": _table(t, SEASONAL_ORDERS, "orders"), "lineitem": _table(t, SEASONAL_LINES, "lines")}
    doomed = t("SELECT CAST(o_orderkey AS INT) AS race_id FROM {orders} WHERE o_orderkey % 7 = 3 OR (o_orderkey % 7 = 5 AND o_orderstatus = 'F')")
    stored.delete_keys(t.spark, list(names.values()), doomed, ["race_id"])
    left = {n: t.spark.table(name) for n, name in names.items()}
    left["orders"] = left["orders"].withColumn("line", F.lit(0))
    return shape.union_all(df.select(F.lit(n).alias("name"), "race_id", "season", "line") for n, df in left.items())


@query(
    "truncate_stored",
    "SELECT 'lineitem' AS name, race_id, season FROM l",
    l=SEASONAL_LINES,
)
def truncate_stored(t: Tables):
    """One of two stored tables emptied; the other one keeps its rows."""
    names = {"orders": _table(t, SEASONAL_ORDERS, "orders"), "lineitem": _table(t, SEASONAL_LINES, "lines")}
    stored.truncate(t.spark, names["orders"])
    left = {n: t.spark.table(name) for n, name in names.items()}
    return shape.union_all(df.select(F.lit(n).alias("name"), "race_id", "season") for n, df in left.items())


STORED_DELTAS = """
SELECT CAST(o_orderkey AS INT) AS race_id, CASE o_orderstatus WHEN 'F' THEN '8' WHEN 'O' THEN '2' ELSE '1' END AS position, 1 AS delta
FROM {orders} WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 7 IN (1, 4)
UNION ALL SELECT CAST(o_orderkey AS INT), '2', 2 FROM {orders} WHERE o_orderstatus = 'O' AND o_orderkey % 7 = 4
"""


@query(
    "correct_stored",
    """
    SELECT lines.* REPLACE (points + coalesce(total, 0) AS points)
    FROM lines LEFT JOIN (SELECT race_id, position, sum(delta) AS total FROM deltas GROUP BY ALL) USING (race_id, position)
    """,
    lines=SEASONAL_LINES, deltas=STORED_DELTAS,
)
def correct_stored(t: Tables):
    """Points corrected in two seasons; two corrections of one key add up."""
    name = _table(t, SEASONAL_LINES, "lines")
    stored.correct(t.spark, name, t(STORED_DELTAS), ["race_id", "position"], "points", "delta")
    return t.spark.table(name)


@query(
    "repair_stored",
    """
    SELECT * REPLACE (CASE WHEN status = 'Finished' AND laps IS NULL AND time_or_retired IS NULL THEN 'SHC'
                           ELSE time_or_retired END AS time_or_retired) FROM lines
    """,
    lines=SEASONAL_LINES,
)
def repair_stored(t: Tables):
    """Finishers without laps and time marked, in the seasons that have some."""
    name = _table(t, SEASONAL_LINES, "lines")
    stored.repair(t.spark, name)
    return t.spark.table(name)


@query("confirm_stored", "SELECT * REPLACE (CASE WHEN race_id % 7 = 2 THEN 'Y' ELSE o_orderstatus END AS o_orderstatus) FROM src", src=SEASONAL_ORDERS)
def confirm_stored(t: Tables):
    """The races of one season marked as ingested."""
    name = _table(t, SEASONAL_ORDERS, "orders")
    stored.confirm(t.spark, name, "o_orderstatus", t("SELECT CAST(o_orderkey AS INT) AS race_id FROM {orders} WHERE o_orderkey % 7 = 2"))
    return t.spark.table(name)


@query("promote_stored", "SELECT race_id, line, points, season FROM lines", lines=SEASONAL_LINES)
def promote_stored(t: Tables):
    """A stored base after two seasons at a time were promoted into it, all of them twice."""
    lines = t(SEASONAL_LINES).select("race_id", "line", "points", "season")
    finished = t.orders.filter(c("o_orderstatus") == "F").select(c("o_orderkey").cast("int").alias("race_id"))
    base, incoming = staging.table_name("base"), staging.table_name("incoming")
    stored.create(lines.join(finished, "race_id", "left_semi"), base, ["season"])
    stored.create(lines, incoming, ["season"])
    for first in (1992, 1994, 1996, 1998):
        for _ in range(2):
            stored.promote_into(t.spark, base, t.spark.table(incoming).filter(c("season").isin(first, first + 1)), ["race_id"])
    return t.spark.table(base)


# --- versions ---


def _versions(t: Tables) -> str:
    name = staging.table_name("snapshots")
    for number, stamp in enumerate(STAMPS):
        rows = t(SNAPSHOT_ROWS).filter(c(VERSION) == number).drop(VERSION)
        versions.write(rows, name, written_at=stamp)
    return name


@query("version_read", "SELECT o_orderkey, o_totalprice, written_at FROM src WHERE _version = 0", src=SNAPSHOT_ROWS)
def version_read(t: Tables):
    """The first of two stored versions."""
    return versions.read(t.spark, _versions(t), 0)


@query(
    "version_history",
    "SELECT CAST(_version AS INTEGER) AS _version, count(*) AS row_count, max(written_at) AS written_at FROM src GROUP BY 1",
    src=SNAPSHOT_ROWS,
)
def version_history(t: Tables):
    """The log of the versions, as counted while they were written."""
    return versions.history(t.spark, _versions(t))


@query(
    "version_restore",
    """
    SELECT CAST(1 AS INTEGER) AS _version, o_orderkey, o_totalprice, written_at FROM src WHERE _version = 1
    UNION ALL SELECT CAST(2 AS INTEGER), o_orderkey, o_totalprice, written_at FROM src WHERE _version = 0
    """,
    src=SNAPSHOT_ROWS,
)
def version_restore(t: Tables):
    """The first version made current again, then all but the latest two dropped."""
    name = _versions(t)
    versions.restore(t.spark, name, 0)
    versions.expire(t.spark, name, 2)
    return versions.read_all(t.spark, name)


# --- run log, schemas, order ---


@query(
    "run_log_stored",
    """
    SELECT 'load' AS "Action", 'loader' AS "User_Name", 'Races' AS "DestinationTable",
           'rows=' || count(*) || ', unfinished=' || count(*) FILTER (o_orderstatus <> 'F') AS "Coment" FROM orders
    UNION ALL SELECT 'load', 'loader', 'Results', 'rows=' || count(*) || ', large=' || count(*) FILTER (l_quantity > 45) FROM lineitem
    UNION ALL SELECT 'clean', 'loader', 'Results', 'rows=' || count(*) FROM lineitem WHERE l_quantity > 45
    """,
)
def run_log_stored(t: Tables):
    """Three steps written and logged; their rows are counted while they are written."""
    folder = f"{staging.shared_folder(t.spark)}/{staging.table_name('run')}"
    log, who = f"{folder}/log", {"User_Name": "loader", "IsPipeline": True}

    def step(rows: DataFrame, path: str, **how) -> None:
        tables.run_step(rows, lambda df: tables.overwrite(df, path), log, **who, **how)

    step(t.orders, f"{folder}/races", Action="load", DestinationTable="Races", metrics={"unfinished": F.count_if(c("o_orderstatus") != "F")})
    step(t.lineitem, f"{folder}/lines", Action="load", DestinationTable="Results", metrics={"large": F.count_if(c("l_quantity") > 45)})
    step(t.lineitem.filter("l_quantity > 45"), f"{folder}/large", Action="clean", DestinationTable="Results")
    return tables.read(t.spark, log).select("Action", "User_Name", "DestinationTable", "Coment")


EVOLVED = "race_id bigint, line int, points double, laps bigint, team string, season int"


@query(
    "schema_generations",
    """
    SELECT CAST(race_id AS BIGINT) AS race_id, line, CAST(CASE WHEN season < 1995 THEN CAST(floor(points) AS INTEGER) ELSE points END AS DOUBLE) AS points,
           CASE WHEN season >= 1995 THEN CAST(laps AS BIGINT) END AS laps, CASE WHEN season >= 1997 THEN 'Team ' || line END AS team, season
    FROM lines
    """,
    lines=SEASONAL_LINES,
)
def schema_generations(t: Tables):
    """Three generations of files with different columns and types, read as one table and migrated season by season."""
    lines = t(SEASONAL_LINES)
    path = f"{staging.shared_folder(t.spark)}/{staging.table_name('generations')}"
    first = lines.filter("season < 1995").select("race_id", "line", F.floor("points").cast("int").alias("points"), "season")
    second = lines.filter("season between 1995 and 1996").select("race_id", "line", "points", c("laps").cast("string").alias("laps"), "season")
    third = lines.filter("season >= 1997").select(
        c("race_id").cast("bigint").alias("race_id"), "line", "points", c("laps").cast("bigint").alias("laps"),
        F.concat(F.lit("Team "), "line").alias("team"), "season",
    )
    for rows in (first, second, third):
        generations.append(rows, path, ["season"])
    name = staging.table_name("migrated")
    generations.migrate(t.spark, path, name, EVOLVED, ["season"])
    return t.spark.table(name)
