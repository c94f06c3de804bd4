"""Updates, deletes, corrections and snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Tables, query
from racelake.operators import changes, snapshots
from racelake.operators.shape import union_all
from racelake.plans import gold

c = F.col

ORDERS = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS season, o_orderstatus, o_totalprice,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS flag,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS INT) END AS race_id
FROM {orders}
"""


@query(
    "update_where",
    """
    SELECT o_orderkey, season, CASE WHEN flag <> '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN flag <> '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, flag, race_id
    FROM src
    """,
    src=ORDERS,
)
def update_where(t: Tables):
    """Two columns set where a condition holds; a null condition changes nothing."""
    return changes.update_where(
        t(ORDERS), c("flag") != "1-URGENT", {"o_orderstatus": F.lit("X"), "o_totalprice": c("o_totalprice") * 2}
    )


@query("confirm_all", "SELECT * REPLACE ('Y' AS flag) FROM src", src=ORDERS)
def confirm_all(t: Tables):
    return changes.confirm(t(ORDERS), "flag")


@query(
    "confirm_loaded",
    """SELECT * REPLACE (CASE WHEN race_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) THEN 'Y' ELSE flag END AS flag)
       FROM src""",
    src=ORDERS,
)
def confirm_loaded(t: Tables):
    """Only the races that were loaded are marked."""
    loaded = t.customer.filter(c("c_acctbal") > 0).select(c("c_custkey").cast("int").alias("race_id"))
    return changes.confirm(t(ORDERS), "flag", loaded)


@query("delete_where", "SELECT * FROM src WHERE NOT coalesce(flag = '2-HIGH' AND season = 1998, false)", src=ORDERS)
def delete_where(t: Tables):
    return changes.delete_where(t(ORDERS), (c("flag") == "2-HIGH") & (c("season") == 1998))


@query(
    "delete_keys",
    """
    SELECT 'orders' AS name, o_orderkey AS id, race_id FROM src
    WHERE race_id IS NULL OR race_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    UNION ALL SELECT 'lineitem', l_orderkey, CAST(l_partkey AS INTEGER) FROM lineitem
    WHERE l_partkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
    src=ORDERS,
)
def delete_keys(t: Tables):
    """The same keys deleted from two tables, and what is left of each."""
    doomed = t.customer.filter(c("c_mktsegment") == "BUILDING").select(c("c_custkey").cast("int").alias("race_id"))
    tables = {
        "orders": t(ORDERS).select(c("o_orderkey").alias("id"), "race_id"),
        "lineitem": t.lineitem.select(c("l_orderkey").alias("id"), c("l_partkey").cast("int").alias("race_id")),
    }
    left = changes.delete_keys_everywhere(tables, doomed, ["race_id"])
    return union_all(df.select(F.lit(name).alias("name"), "id", "race_id") for name, df in left.items())


@query(
    "truncate_all",
    """
    SELECT 'orders' AS name, o_orderkey AS id, season FROM src WHERE false
    UNION ALL SELECT 'customer', c_custkey, NULL FROM customer UNION ALL SELECT 'supplier', s_suppkey, NULL FROM supplier
    """,
    src=ORDERS,
)
def truncate_all(t: Tables):
    """One of three tables emptied."""
    rows = {
        "orders": t(ORDERS).select(c("o_orderkey").alias("id"), "season"),
        "customer": t.customer.select(c("c_custkey").alias("id"), F.lit(None).cast("int").alias("season")),
        "supplier": t.supplier.select(c("s_suppkey").alias("id"), F.lit(None).cast("int").alias("season")),
    }
    rows["orders"] = changes.emptied(rows["orders"])
    return union_all(df.select(F.lit(name).alias("name"), "id", "season") for name, df in rows.items())


@query("sample_copy", "SELECT * FROM src WHERE season IN (1996, 1999)", src=ORDERS)
def sample_copy(t: Tables):
    """Whole seasons copied for a trial."""
    return changes.season_sample(t(ORDERS), [1996, 1999])


RESULTS = """
SELECT CAST(l_orderkey AS INT) AS Race_Id, CAST(l_linenumber AS STRING) AS Position, l_partkey,
       CASE WHEN l_quantity > 48 THEN NULL ELSE l_quantity END AS Points
FROM {lineitem}
"""
DELTAS = """
SELECT CAST(o_orderkey AS INT) AS Race_Id, CASE o_orderstatus WHEN 'F' THEN '8' WHEN 'O' THEN '2' ELSE '1' END AS Position, 1 AS Delta
FROM {orders} WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT CAST(o_orderkey AS INT), '2', 2 FROM {orders} WHERE o_orderstatus = 'O'
"""


@query(
    "points_corrections",
    """
    SELECT "Race_Id", "Position", l_partkey, "Points" + coalesce(delta, 0) AS "Points"
    FROM results LEFT JOIN (SELECT "Race_Id", "Position", sum("Delta") AS delta FROM deltas GROUP BY ALL) USING ("Race_Id", "Position")
    """,
    results=RESULTS, deltas=DELTAS,
)
def points_corrections(t: Tables):
    """Points corrected by race and position; two corrections of one key add up."""
    return gold.correct_points(t(RESULTS), t(DELTAS))


SCRATCHED = """
SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN 'Finished' ELSE 'DNF' END AS status,
       CASE WHEN l_quantity < 10 THEN NULL ELSE CAST(l_quantity AS INT) END AS laps,
       CASE WHEN l_linenumber IN (2, 5) THEN NULL ELSE 'OK' END AS time_or_retired
FROM {lineitem}
"""


@query(
    "repair_missing",
    """
    SELECT * REPLACE (CASE WHEN status = 'Finished' AND laps IS NULL AND time_or_retired IS NULL THEN 'SHC'
                           ELSE time_or_retired END AS time_or_retired) FROM src
    """,
    src=SCRATCHED,
)
def repair_missing(t: Tables):
    return changes.mark_scratched(t(SCRATCHED))


@query(
    "repair_report",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, time_or_retired AS before, 'SHC' AS after FROM src
    WHERE status = 'Finished' AND laps IS NULL AND time_or_retired IS NULL
    """,
    src=SCRATCHED,
)
def repair_report(t: Tables):
    """The rows that the repair changes, with the value before and after it."""
    cases = t(SCRATCHED).withColumns({"before": c("time_or_retired"), "case": changes.lacks_time()}).filter("case")
    fixed = changes.mark_scratched(cases).filter(~F.coalesce(changes.lacks_time(), F.lit(False)))
    return fixed.select("l_orderkey", "l_partkey", "l_linenumber", "before", c("time_or_retired").alias("after"))


# two versions of a table: the second has new prices and one order status less
STAMPS = ("2024-01-01T00:00:00", "2024-02-01T00:00:00")
SNAPSHOT_ROWS = SNAPSHOTS = """
SELECT 0 AS _version, o_orderkey, o_totalprice, '2024-01-01T00:00:00' AS written_at FROM {orders}
UNION ALL
SELECT 1 AS _version, o_orderkey, o_totalprice + 1, '2024-02-01T00:00:00' AS written_at FROM {orders} WHERE o_orderstatus <> 'P'
"""


@query("snapshot_read", "SELECT o_orderkey, o_totalprice, written_at FROM src WHERE _version = 0", src=SNAPSHOTS)
def snapshot_read(t: Tables):
    return snapshots.at_version(t(SNAPSHOTS), 0)


@query(
    "snapshot_history",
    "SELECT CAST(_version AS INTEGER) AS _version, count(*) AS row_count, max(written_at) AS written_at FROM src GROUP BY 1",
    src=SNAPSHOTS,
)
def snapshot_history(t: Tables):
    return snapshots.history(t(SNAPSHOTS), "written_at")


@query(
    "snapshot_restore",
    """
    SELECT CAST(_version AS INTEGER) AS _version, o_orderkey, o_totalprice, written_at FROM src
    UNION ALL SELECT CAST(2 AS INTEGER), o_orderkey, o_totalprice, written_at FROM src WHERE _version = 0
    """,
    src=SNAPSHOTS,
)
def snapshot_restore(t: Tables):
    return snapshots.restored(t(SNAPSHOTS), 0, as_version=2)
