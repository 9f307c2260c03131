"""F5 / F7: PII search, tags, grants, effective access, lineage, checks, ids."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.operators import checks, govern
from verlog.operators.ids import assign_ids


def customers_schema():
    def c(name, typ, comment):
        return T.StructField(name, typ, True, {"comment": comment})
    return T.StructType([
        c("customer_id", T.IntegerType(), "Surrogate key"), c("name", T.StringType(), "Full name"),
        c("email", T.StringType(), "Contact email - personal data, restrict access"),
        c("city", T.StringType(), "City"), c("tier", T.StringType(), "Loyalty tier"),
        c("signup_date", T.DateType(), "Signup date"),
    ])


def test_pii_and_tags(spark):
    cust = spark.createDataFrame([], customers_schema())
    inv = govern.column_inventory(spark, {"customers": cust}, "demo_cat", "governance")
    assert [r.column_name for r in govern.pii_columns(inv).collect()] == ["email"]
    tags = spark.createDataFrame([("customers", "email", "pii", "true")],
                                 "table_name string, column_name string, tag_name string, tag_value string")
    assert govern.tagged_columns(inv, tags).count() == 1


def grants_ledger(spark, revoke_select: bool):
    rows = [
        (1, "GRANT", "USE CATALOG", "CATALOG", "demo_cat", "analysts"),
        (2, "GRANT", "USE SCHEMA", "SCHEMA", "demo_cat.governance", "analysts"),
        (3, "GRANT", "SELECT", "TABLE", "demo_cat.governance.customers_public", "analysts"),
    ]
    if revoke_select:
        rows.append((4, "REVOKE", "SELECT", "TABLE", "demo_cat.governance.customers_public", "analysts"))
    base = dt.datetime(2025, 1, 1)
    return spark.createDataFrame([(base + dt.timedelta(minutes=i), i, a, p, ot, on, pr) for i, a, p, ot, on, pr in rows],
                                 "ts timestamp, seq long, action string, privilege string, object_type string, "
                                 "object_name string, principal string")


def test_effective_access(spark):
    g = govern.current_grants(grants_ledger(spark, False))
    assert [r.principal for r in govern.effective_access(g, "demo_cat", "governance", "customers_public").collect()] \
        == ["analysts"]
    assert govern.effective_access(g, "demo_cat", "governance", "customers").count() == 0
    g2 = govern.current_grants(grants_ledger(spark, True))
    assert govern.effective_access(g2, "demo_cat", "governance", "customers_public").count() == 0


def test_lineage_prefix_is_literal(spark):
    edges = spark.createDataFrame(
        [(1, "a", "demo_cat.governance.t1", dt.datetime(2025, 1, 2), dt.date(2025, 1, 2)),
         (2, "a", "demoXuc.governance.t2", dt.datetime(2025, 1, 2), dt.date(2025, 1, 2)),
         (3, "a", "demo_cat.governance.t3", dt.datetime(2024, 1, 2), dt.date(2024, 1, 2))],
        "edge_id long, source_table_full_name string, target_table_full_name string, event_time timestamp, "
        "event_date date")
    got = [r.edge_id for r in govern.recent_lineage(edges, "demo_cat.governance.", "2025-01-01").collect()]
    assert got == [1]


def test_scoreboard_evaluates_every_check(spark):
    a = spark.range(3)
    board = checks.scoreboard({
        "same": checks.equal_rows("same", a, spark.range(3)),
        "different": checks.equal_rows("different", a, spark.range(4)),
    })
    st = {r.check_name: r.status for r in board.collect()}
    assert st == {"same": "PASS", "different": "FAIL"}
    with pytest.raises(checks.ChecksFailed):
        checks.raise_on_failure(board)


def test_preflight(spark):
    out = checks.preflight_counts({"x": spark.range(100), "y": spark.range(5)}, {"x": 100, "y": 6})
    assert {r.table_name: r.status for r in out.collect()} == {"x": "PASS", "y": "FAIL"}


def test_assign_ids_contiguous_across_partitions(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("v"))
    out = assign_ids(df, "rid", 11, order_by=["v"]).collect()
    assert sorted(r.rid for r in out) == list(range(11, 1011))
    assert all(r.rid == r.v + 11 for r in out)


def test_catalog_inventory_from_session_catalog(spark):
    spark.createDataFrame([], customers_schema()).createOrReplaceTempView("verlog_inv_customers")
    inv = govern.catalog_inventory(spark, "default")
    mine = inv.where(F.col("table_name") == "verlog_inv_customers")
    assert [r.column_name for r in mine.orderBy("ordinal_position").collect()][:3] == ["customer_id", "name", "email"]
    assert [r.column_name for r in govern.pii_columns(mine).collect()] == ["email"]
