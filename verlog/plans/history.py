"""The scripted history on the driver's ``orders`` table, written once per data folder.

Versions (key ``order_id``):

====  ========  ==============================================================
  0   create    empty
  1   insert    orders with ``order_day < 2001-01-01``
  2   update    ``status = 'F'`` where ``status = 'O' AND order_day < 1997-01-01``
  3   delete    ``status = 'P' AND priority = '5-LOW'``
  4   merge     source = orders with ``2000-10-01 <= order_day < 2001-03-01`` and
                ``status = 'R'``; matched -> set status, not matched -> insert
  5   update    the incident: ``total = 0`` where ``priority = '1-URGENT'``
  6   insert    good work after it: orders with ``order_day >= 2001-03-01``
====  ========  ==============================================================

Every version is a function of the whole table. Building resumes from the
last committed version, so a run that died half way continues where it
stopped; rebuilding a version overwrites its partition. A base is written at version 4.
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verlog.session import work_root
from verlog.sources.testdata import ORDERS_ROWS_SQL, orders_rows
from verlog.sources.versioned import BASE_INTERVAL, VersionedTable

# Bump when the script below changes, so older fixtures are not reused.
HISTORY_REV = 6
KEYS = ["order_id"]
N_VERSIONS = 6
#: Versions between bases: the queries read a base at version 4 and the changes of 5 and 6.
BASE_EVERY = 4

# The dates and codes that define the scripted history.
V1_BEFORE = "2001-01-01"
V2_OPEN_BEFORE = "1997-01-01"
V4_FROM, V4_UNTIL = "2000-10-01", "2001-03-01"
V6_FROM = "2001-03-01"
INCIDENT_PRIORITY = "1-URGENT"


def fixture_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    digest = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:10]
    return f"{work_root(spark)}/verlog-fixtures/{name}-{digest}-r{HISTORY_REV}"


def _steps(src: DataFrame):
    d = F.col("order_day")
    return [
        lambda t: t.insert(src.where(d < F.lit(V1_BEFORE).cast("date"))),
        lambda t: t.update({"status": F.lit("F")},
                           (F.col("status") == "O") & (d < F.lit(V2_OPEN_BEFORE).cast("date"))),
        lambda t: t.delete((F.col("status") == "P") & (F.col("priority") == "5-LOW")),
        lambda t: t.merge(
            src.where((d >= F.lit(V4_FROM).cast("date")) & (d < F.lit(V4_UNTIL).cast("date")))
               .withColumn("status", F.lit("R")),
            KEYS, matched_update={"status": "s.status"}, not_matched_insert="*"),
        lambda t: t.update({"total": F.lit(0)}, F.col("priority") == INCIDENT_PRIORITY),
        lambda t: t.insert(src.where(d >= F.lit(V6_FROM).cast("date"))),
    ]


_BUILD_LOCK = threading.Lock()


def orders_history(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """The versioned ``orders`` table at version 6 (built or resumed on first use)."""
    path = fixture_path(spark, sf_dir, "orders")
    t = VersionedTable(spark, path)
    if t.exists() and t.version() >= N_VERSIONS:
        return t
    with _BUILD_LOCK:  # one writer per table, also when queries run in threads
        return _build(spark, sf_dir, path)


def _build(spark: SparkSession, sf_dir: str, path: str) -> VersionedTable:
    t = VersionedTable(spark, path)
    if t.exists() and t.version() >= N_VERSIONS:
        return t
    src = orders_rows(spark, sf_dir)
    if not t.exists():
        t = VersionedTable.create(spark, path, src.schema, KEYS, {BASE_INTERVAL: str(BASE_EVERY)})
    steps = _steps(src)
    for i in range(t.version(), len(steps)):
        steps[i](t)
    return t


# --------------------------------------------------------------------------
# The same history as a plain DuckDB CTE chain, written independently of the
# change-log code: each version is computed from the previous one with WHERE
# and CASE only. ``vN`` are the table states, ``cN`` the change rows.
HISTORY_SQL = f"""
src AS MATERIALIZED ({ORDERS_ROWS_SQL}),
v1 AS MATERIALIZED (SELECT * FROM src WHERE order_day < DATE '{V1_BEFORE}'),
v2 AS MATERIALIZED (SELECT order_id, cust_id,
              CASE WHEN status = 'O' AND order_day < DATE '{V2_OPEN_BEFORE}' THEN 'F' ELSE status END AS status,
              total, order_day, priority FROM v1),
v3 AS MATERIALIZED (SELECT * FROM v2 WHERE NOT (status = 'P' AND priority = '5-LOW')),
m4 AS MATERIALIZED (SELECT order_id, cust_id, 'R' AS status, total, order_day, priority FROM src
       WHERE order_day >= DATE '{V4_FROM}' AND order_day < DATE '{V4_UNTIL}'),
v4 AS MATERIALIZED (SELECT v3.order_id, v3.cust_id,
              CASE WHEN m4.order_id IS NOT NULL THEN m4.status ELSE v3.status END AS status,
              v3.total, v3.order_day, v3.priority
       FROM v3 LEFT JOIN m4 ON v3.order_id = m4.order_id
       UNION ALL
       SELECT * FROM m4 WHERE order_id NOT IN (SELECT order_id FROM v3)),
v5 AS MATERIALIZED (SELECT order_id, cust_id, status,
              CASE WHEN priority = '{INCIDENT_PRIORITY}' THEN CAST(0 AS DECIMAL(18,2)) ELSE total END AS total,
              order_day, priority FROM v4),
v6 AS MATERIALIZED (SELECT * FROM v5 UNION ALL SELECT * FROM src WHERE order_day >= DATE '{V6_FROM}'),
c1 AS MATERIALIZED (SELECT *, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version FROM v1),
c2 AS MATERIALIZED (SELECT *, 'update_preimage' AS _change_type, CAST(2 AS BIGINT) AS _commit_version FROM v1
       WHERE status = 'O' AND order_day < DATE '{V2_OPEN_BEFORE}'
       UNION ALL
       SELECT order_id, cust_id, 'F', total, order_day, priority, 'update_postimage', 2 FROM v1
       WHERE status = 'O' AND order_day < DATE '{V2_OPEN_BEFORE}'),
v3_gone AS MATERIALIZED (SELECT * FROM v2 WHERE status = 'P' AND priority = '5-LOW'),
c3 AS MATERIALIZED (SELECT *, 'delete' AS _change_type, CAST(3 AS BIGINT) AS _commit_version FROM v3_gone),
c4 AS MATERIALIZED (SELECT v3.*, 'update_preimage' AS _change_type, CAST(4 AS BIGINT) AS _commit_version FROM v3 JOIN m4 ON v3.order_id = m4.order_id
       UNION ALL
       SELECT v3.order_id, v3.cust_id, m4.status, v3.total, v3.order_day, v3.priority, 'update_postimage', 4
       FROM v3 JOIN m4 ON v3.order_id = m4.order_id
       UNION ALL
       SELECT *, 'insert', 4 FROM m4 WHERE order_id NOT IN (SELECT order_id FROM v3)),
c5 AS MATERIALIZED (SELECT *, 'update_preimage' AS _change_type, CAST(5 AS BIGINT) AS _commit_version FROM v4 WHERE priority = '{INCIDENT_PRIORITY}'
       UNION ALL
       SELECT order_id, cust_id, status, CAST(0 AS DECIMAL(18,2)), order_day, priority, 'update_postimage', 5
       FROM v4 WHERE priority = '{INCIDENT_PRIORITY}'),
c6 AS MATERIALIZED (SELECT *, 'insert' AS _change_type, CAST(6 AS BIGINT) AS _commit_version FROM src WHERE order_day >= DATE '{V6_FROM}'),
feed AS (SELECT * FROM c1 UNION ALL SELECT * FROM c2 UNION ALL SELECT * FROM c3 UNION ALL SELECT * FROM c4
         UNION ALL SELECT * FROM c5 UNION ALL SELECT * FROM c6)
"""


def with_history(select_sql: str) -> str:
    """An oracle query over the CTE chain."""
    return f"WITH {HISTORY_SQL.strip()}\n{select_sql}"
