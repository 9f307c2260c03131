"""Registered queries about a table's upkeep: layout, replacing, refused writes, bounds of the feed, access, dictionary."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.operators import changes as ch
from verlog.operators import govern, layout, recover, rules
from verlog.operators.ids import assign_ids
from verlog.plans.catalog import query, scratch
from verlog.plans.history import INCIDENT_PRIORITY, orders_history, with_history
from verlog.sources import testdata as td
from verlog.sources.versioned import VersionedTable


# ============================================================== layout
def _in_small_files(spark, df: DataFrame, what: str) -> str:
    path = scratch(spark, what)
    df.write.option("maxRecordsPerFile", 5000).parquet(path)
    return path


@query("compact_same_rows", """
SELECT 'original' AS relation, count(*) AS row_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_sum FROM lineitem
UNION ALL
SELECT 'compacted', count(*), CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) FROM lineitem
""")
def compact_same_rows(spark, sf):
    """OPTIMIZE: small files rewritten into files of a target size; counts and totals must not change."""
    li = td.table(spark, sf, "lineitem")
    packed = layout.compact(spark, _in_small_files(spark, li, "small"), scratch(spark, "compact"))
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return recover.totals({"original": li.withColumn("v", price), "compacted": packed.withColumn("v", price)}, "v")


@query("compact_group_hashes", """
SELECT l_returnflag, l_linestatus, count(*) AS row_count, true AS same_rows, true AS fewer_files
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def compact_group_hashes(spark, sf):
    """Compaction held against the original over every column: an order-free hash of each group's whole rows, and
    no more files than the bytes of the small ones fill (one more for a rest)."""
    li = td.table(spark, sf, "lineitem")
    small, out = _in_small_files(spark, li, "small-hash"), scratch(spark, "compact-hash")
    packed = layout.compact(spark, small, out)
    before, after = (layout.file_inventory(spark, p).agg(F.count("*").alias("n"), F.sum("length").alias("b")).first()
                     for p in (small, out))
    fewer = after.n <= math.ceil(before.b / layout.TARGET_BYTES) + 1
    by = ["l_returnflag", "l_linestatus"]
    was, now = (layout.group_hashes(df, by).select(*by, F.struct("rows", "h0", "h1").alias(name))
                for df, name in ((li, "was"), (packed, "now")))
    return was.join(now, by, "full").select(
        *by, F.col("now.rows").alias("row_count"), F.col("was").eqNullSafe(F.col("now")).alias("same_rows"),
        F.lit(fewer).alias("fewer_files"))


_HOT_ORDERS = "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END"


@query("cluster_skipping", f"""
WITH o AS (SELECT {_HOT_ORDERS} AS cust, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT 'cust' AS column_name, count(DISTINCT cust) AS values_probed, count(*) AS row_count, true AS opens_fewer_files,
       true AS no_heavy_file FROM o
UNION ALL SELECT 'day', count(DISTINCT day), count(*), true, true FROM o
""")
def cluster_skipping(spark, sf):
    """ZORDER BY (cust, day) where one customer has a third of the orders: for each column, over every value it has,
    an equality filter opens fewer files than before, and the hot customer fills no file beyond its share."""
    o = td.table(spark, sf, "orders")
    src = o.select(F.expr(_HOT_ORDERS).alias("cust"), F.col("o_orderdate").cast("date").alias("day"), "o_orderkey",
                   "o_orderstatus", "o_totalprice")
    size = layout.file_inventory(spark, f"{sf.rstrip('/')}/orders.parquet").agg(F.sum("length")).first()[0] or 0
    files = max(16, math.ceil(size / layout.TARGET_BYTES))
    plain = scratch(spark, "unclustered")
    src.repartition(files).write.parquet(plain)
    before, after = spark.read.parquet(plain), layout.cluster(src, scratch(spark, "clustered"), ["cust", "day"], files)
    rows = None
    for c in ("cust", "day"):
        was, now = layout.skipping(before, c).first(), layout.skipping(after, c)
        row = now.select(F.lit(c).alias("column_name"), F.col("values").alias("values_probed"),
                         F.lit(after.count()).cast("long").alias("row_count"),
                         (F.col("probes") < was.probes * 0.75).alias("opens_fewer_files"),
                         (F.col("largest_share") <= 2 / files).alias("no_heavy_file"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


# ============================================================== replace
@query("replace_clone", with_history("""
SELECT 'before' AS contents, priority, count(*) AS row_count, CAST(sum(total) AS DECIMAL(38,2)) AS total_sum FROM v1 GROUP BY priority
UNION ALL SELECT 'now', priority, count(*), CAST(sum(total) AS DECIMAL(38,2)) FROM v4 GROUP BY priority
"""))
def replace_clone(spark, sf):
    """CREATE OR REPLACE ... CLONE onto a table that is there: it holds version 4 now, and its own past still."""
    t = orders_history(spark, sf)
    path = scratch(spark, "replaced")
    t.clone(path, version=1)
    c = t.clone(path, version=4, replace=True)
    parts = [df.groupBy("priority").agg(F.count(F.lit(1)).alias("row_count"),
                                        F.sum("total").cast("decimal(38,2)").alias("total_sum"))
             .select(F.lit(name).alias("contents"), "priority", "row_count", "total_sum")
             for name, df in (("before", c.as_of(0)), ("now", c.current()))]
    return parts[0].unionByName(parts[1])


@query("replace_as_select", with_history("""
SELECT order_id, cust_id, CAST(round(total / 1000) AS BIGINT) AS thousands FROM v6 WHERE status = 'O'
"""))
def replace_as_select(spark, sf):
    """CREATE OR REPLACE TABLE ... AS SELECT onto a table that is there: other rows and other columns."""
    t = orders_history(spark, sf)
    c = t.clone(scratch(spark, "reselected"), version=1)
    c.replace_with(t.current().where("status = 'O'").select(
        "order_id", "cust_id", F.round(F.col("total") / 1000).cast("long").alias("thousands")))
    return c.current()


# ============================================================== history
@query("commit_times", with_history("""
SELECT CAST(v AS BIGINT) AS version, operation, true AS has_user, true AS after_the_one_before, rows_then,
       CAST(updated AS BIGINT) AS rows_updated, CAST(deleted AS BIGINT) AS rows_deleted
FROM (SELECT 1 AS v, 'WRITE' AS operation, (SELECT count(*) FROM v1) AS rows_then, 0 AS updated, 0 AS deleted
      UNION ALL SELECT 2, 'UPDATE', (SELECT count(*) FROM v2), (SELECT count(*) // 2 FROM c2), 0
      UNION ALL SELECT 3, 'DELETE', (SELECT count(*) FROM v3), 0, (SELECT count(*) FROM c3)
      UNION ALL SELECT 4, 'MERGE', (SELECT count(*) FROM v4), (SELECT count(*) FROM c4 WHERE _change_type = 'update_postimage'), 0
      UNION ALL SELECT 5, 'UPDATE', (SELECT count(*) FROM v5), (SELECT count(*) // 2 FROM c5), 0
      UNION ALL SELECT 6, 'WRITE', (SELECT count(*) FROM v6), 0, 0)
"""))
def commit_times(spark, sf):
    """The audit log with commit times and users: each version's own time, given back as TIMESTAMP AS OF, reads the rows
    of that version, counted from the states in one scan for all of them."""
    t = orders_history(spark, sf)
    audit = t.audit().where("version > 0")
    times = {r.version: r.timestamp for r in audit.select("version", "timestamp").collect()}
    found = {v: t.version_at(at.astimezone()) for v, at in times.items()}
    counted = t.as_of_many(sorted(set(found.values()))).groupBy(F.col(ch.AS_OF).alias("found")).agg(
        F.count(F.lit(1)).alias("rows_then"))
    place = F.create_map(*[x for v, f in found.items() for x in (F.lit(v).cast("long"), F.lit(f).cast("long"))])
    return (audit.withColumn("found", place[F.col("version")]).join(counted, "found")
            .select("version", "operation", F.col("userName").isNotNull().alias("has_user"),
                    (F.col("timestamp") > F.col("timestamp_before")).alias("after_the_one_before"), "rows_then",
                    F.col("rows_updated"), F.col("rows_deleted")))


@query("feed_bounds", with_history("""
SELECT _commit_version AS version, count(*) AS changes, min(order_id) AS first_order, max(order_id) AS last_order
FROM feed WHERE _commit_version BETWEEN 2 AND 4 GROUP BY _commit_version
"""))
def feed_bounds(spark, sf):
    """``table_changes(t, 2, 4)``: both bounds belong to the feed, and reach the scan as partition filters."""
    return orders_history(spark, sf).changes(2, 4).groupBy(F.col(ch.COMMIT_VERSION).alias("version")).agg(
        F.count(F.lit(1)).alias("changes"), F.min("order_id").alias("first_order"), F.max("order_id").alias("last_order"))


@query("diff_sorted", with_history("""
SELECT row_number() OVER (ORDER BY order_id, change_type) AS place, * FROM (
  SELECT coalesce(o.order_id, n.order_id) AS order_id,
         CASE WHEN o.order_id IS NULL THEN 'ADDED' WHEN n.order_id IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change_type
  FROM v1 o FULL JOIN v6 n ON o.order_id = n.order_id
  WHERE o.order_id IS NULL OR n.order_id IS NULL OR o.status IS DISTINCT FROM n.status OR o.total IS DISTINCT FROM n.total)
"""))
def diff_sorted(spark, sf):
    """The changed rows of a diff, sorted on the coalesced key, with each row's place in that order."""
    moved = orders_history(spark, sf).diff(1, compare=["status", "total"], changed_only=True)
    return assign_ids(moved.select("order_id", "change_type"), "place", order_by=["order_id", "change_type"])


# ============================================================== refused writes
@query("refused_rows", """
SELECT 'quantity' AS refused_column, l_orderkey AS order_id, l_linenumber AS line FROM lineitem
WHERE CAST(CAST(l_extendedprice AS DECIMAL(12, 1)) AS DOUBLE) <> l_extendedprice
""")
def refused_rows(spark, sf):
    """Rows that schema enforcement refuses: their price does not fit a column with one decimal."""
    batch = td.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
                                                   F.col("l_extendedprice").alias("quantity"))
    table = T.StructType([T.StructField("order_id", T.LongType()),
                          T.StructField("line", batch.schema["line"].dataType),
                          T.StructField("quantity", T.DecimalType(12, 1))])
    return rules.refused_rows(batch, table).select("refused_column", "order_id", "line")


@query("refused_batches", f"""
WITH n AS (SELECT count(*) AS kept FROM orders WHERE o_totalprice > 50000),
     b(batch, bad) AS (
  SELECT 'not null', count(*) FILTER (WHERE o_orderpriority = '{INCIDENT_PRIORITY}') FROM orders
  UNION ALL SELECT 'check', count(*) FILTER (WHERE o_totalprice <= 50000) FROM orders
  UNION ALL SELECT 'unexpected column', count(*) FROM orders
  UNION ALL SELECT 'type', count(*) FILTER (WHERE CAST(o_totalprice AS DECIMAL(18,2)) <> trunc(o_totalprice)) FROM orders
  UNION ALL SELECT 'key held twice', count(*) FILTER (WHERE o_totalprice > 50000) FROM orders)
SELECT batch, bad > 0 AS refused, kept AS rows_after, CAST(1 AS BIGINT) AS version_after FROM b, n
""")
def refused_batches(spark, sf):
    """Batches that break NOT NULL, CHECK, the columns, a type or the key: each is refused, and the table stays."""
    src = td.orders_rows(spark, sf)
    schema = T.StructType([T.StructField("order_id", T.LongType(), False), T.StructField("total", T.DecimalType(18, 2)),
                           T.StructField("lines", T.IntegerType()), T.StructField("priority", T.StringType(), False)])
    t = VersionedTable.create(spark, scratch(spark, "refusals"), schema, ["order_id"], checks={"positive": "total > 50000"})
    rows = src.select("order_id", "total", F.lit(1).alias("lines"), "priority")
    good = rows.where("total > 50000")
    t.insert(good)
    fresh = rows.withColumn("order_id", F.col("order_id") + 1_000_000_000)
    batches = {
        "not null": fresh.where("total > 50000").withColumn(
            "priority", F.when(F.col("priority") != INCIDENT_PRIORITY, F.col("priority"))),
        "check": fresh,
        "unexpected column": fresh.where("total > 50000").withColumn("region", F.lit("South")),
        "type": fresh.where("total > 50000").withColumn("lines", F.col("total").cast("double")),
        "key held twice": good,
    }
    out = []
    for name, batch in batches.items():
        try:
            t.insert(batch)
            refused = False
        except rules.RuleViolation:
            refused = True
        out.append((name, refused, t.version()))
    outcome = spark.createDataFrame(out, "batch string, refused boolean, version_after long")
    # The rows that are there after all of it.
    kept = t.current().agg(F.count(F.lit(1)).alias("rows_after"))
    return outcome.withColumn("rows_after", F.lit(kept.first()[0]).cast("long")).select(
        "batch", "refused", "rows_after", "version_after")


# ============================================================== governance
_GRANTS = """
SELECT 'user_' || CAST(user_id % 40 AS VARCHAR) AS principal, event_id AS seq, ts,
       CASE WHEN event_type = 'error' THEN 'REVOKE' ELSE 'GRANT' END AS action,
       CASE event_id % 10 WHEN 0 THEN 'USE CATALOG' WHEN 1 THEN 'USE CATALOG' WHEN 2 THEN 'USE SCHEMA' WHEN 3 THEN 'USE SCHEMA'
            WHEN 4 THEN 'USE SCHEMA' ELSE 'SELECT' END AS privilege,
       CASE event_id % 10 WHEN 2 THEN 'SCHEMA' WHEN 3 THEN 'SCHEMA' WHEN 6 THEN 'SCHEMA' WHEN 7 THEN 'TABLE' WHEN 8 THEN 'TABLE'
            WHEN 9 THEN 'TABLE' ELSE 'CATALOG' END AS object_type,
       'cat' || CAST(event_id // 10 % 3 AS VARCHAR) AS cat, 'sch' || CAST(event_id // 30 % 4 AS VARCHAR) AS sch,
       'tab' || CAST(event_id // 120 % 9 AS VARCHAR) AS tab FROM events
"""


@query("effective_access_all", f"""
WITH l AS (SELECT *, CASE object_type WHEN 'CATALOG' THEN cat WHEN 'SCHEMA' THEN cat || '.' || sch
                     ELSE cat || '.' || sch || '.' || tab END AS object_name FROM ({_GRANTS})),
     g AS (SELECT principal, privilege, object_type, object_name FROM (
           SELECT *, row_number() OVER (PARTITION BY privilege, object_type, object_name, principal
                                        ORDER BY ts DESC, seq DESC) AS rn FROM l) WHERE rn = 1 AND action = 'GRANT'),
     o AS (SELECT DISTINCT cat, sch, tab FROM l),
     p AS (SELECT DISTINCT principal FROM g)
SELECT p.principal, o.cat || '.' || o.sch || '.' || o.tab AS object_name FROM p, o
WHERE EXISTS (SELECT 1 FROM g WHERE g.principal = p.principal AND privilege = 'USE CATALOG' AND object_name = o.cat)
  AND EXISTS (SELECT 1 FROM g WHERE g.principal = p.principal AND privilege = 'USE SCHEMA'
              AND object_name IN (o.cat, o.cat || '.' || o.sch))
  AND EXISTS (SELECT 1 FROM g WHERE g.principal = p.principal AND privilege = 'SELECT'
              AND object_name IN (o.cat, o.cat || '.' || o.sch, o.cat || '.' || o.sch || '.' || o.tab))
""")
def effective_access_all(spark, sf):
    """Every principal and every object it can read, privileges inherited from schema and catalog."""
    e = td.table(spark, sf, "events")
    kind = F.col("event_id") % 10

    def number(by: int, of: int):
        return (F.floor(F.col("event_id") / by) % of).cast("string")

    ledger = e.select(
        F.concat(F.lit("user_"), (F.col("user_id") % 40).cast("string")).alias("principal"), F.col("event_id").alias("seq"), "ts",
        F.when(F.col("event_type") == "error", "REVOKE").otherwise("GRANT").alias("action"),
        F.when(kind <= 1, "USE CATALOG").when(kind <= 4, "USE SCHEMA").otherwise("SELECT").alias("privilege"),
        F.when(kind.isin(2, 3, 6), "SCHEMA").when(kind >= 7, "TABLE").otherwise("CATALOG").alias("object_type"),
        F.concat(F.lit("cat"), number(10, 3)).alias("catalog"), F.concat(F.lit("sch"), number(30, 4)).alias("schema"),
        F.concat(F.lit("tab"), number(120, 9)).alias("object"))
    name = F.when(F.col("object_type") == "CATALOG", F.col("catalog")) \
        .when(F.col("object_type") == "SCHEMA", F.concat_ws(".", "catalog", "schema")) \
        .otherwise(F.concat_ws(".", "catalog", "schema", "object"))
    grants = govern.current_grants(ledger.withColumn("object_name", name))
    return govern.access(grants, ledger.select("catalog", "schema", "object").distinct())


@query("data_dictionary", f"""
SELECT * FROM (
  SELECT 'orders' AS table_name, 'order_id' AS column_name, CAST(1 AS BIGINT) AS ordinal_position, 'bigint' AS data_type,
         'number of the order, never reused' AS comment, (SELECT count(o_orderkey) FROM orders) AS non_null_rows
  UNION ALL SELECT 'orders', 'cust_id', 2, 'bigint', 'who ordered', (SELECT count(o_custkey) FROM orders)
  UNION ALL SELECT 'orders', 'status', 3, 'string', NULL, (SELECT count(o_orderstatus) FROM orders)
  UNION ALL SELECT 'orders', 'total', 4, 'decimal(18,2)', 'price of all lines', (SELECT count(o_totalprice) FROM orders)
  UNION ALL SELECT 'orders', 'order_day', 5, 'date', NULL, (SELECT count(o_orderdate) FROM orders)
  UNION ALL SELECT 'orders', 'priority', 6, 'string', 'empty for {INCIDENT_PRIORITY}: not for analysts',
         (SELECT count(*) FILTER (WHERE o_orderpriority <> '{INCIDENT_PRIORITY}') FROM orders))
""")
def data_dictionary(spark, sf):
    """The dictionary of a table created with comments: place, type, comment, and how many rows hold a value."""
    src = td.orders_rows(spark, sf)
    said = {"order_id": "number of the order, never reused", "cust_id": "who ordered", "total": "price of all lines",
            "priority": f"empty for {INCIDENT_PRIORITY}: not for analysts"}
    schema = T.StructType([T.StructField(f.name, f.dataType, True, {"comment": said[f.name]} if f.name in said else {})
                           for f in src.schema.fields])
    t = VersionedTable.create(spark, scratch(spark, "commented"), schema, ["order_id"])
    t.insert(src.withColumn("priority", F.when(F.col("priority") != INCIDENT_PRIORITY, F.col("priority"))))
    return govern.data_dictionary(spark, {"orders": t.described()})

