"""F3 (end-to-end orders, identity BY DEFAULT) and F5 (governed customers)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.operators import changes as ch
from verlog.operators import govern, recover
from verlog.operators.rules import RuleViolation
from verlog.sources.versioned import VersionedTable

# The rows below and their results are those of FIXTURES.md.
D = dt.date.fromisoformat
SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType(), False), T.StructField("customer", T.StringType(), False),
    T.StructField("region", T.StringType()), T.StructField("product", T.StringType()),
    T.StructField("quantity", T.IntegerType()), T.StructField("unit_price", T.DecimalType(10, 2)),
    T.StructField("order_date", T.DateType()), T.StructField("status", T.StringType()),
])
NO_ID = T.StructType(SCHEMA.fields[1:])
ROWS = [("Aarav Sharma", "South", "Laptop", 1, Decimal("1200.00"), D("2025-01-10"), "delivered"),
        ("Priya Nair", "South", "Monitor", 2, Decimal("300.00"), D("2025-01-12"), "shipped"),
        ("Rohan Iyer", "West", "Keyboard", 3, Decimal("80.00"), D("2025-01-15"), "placed"),
        ("Meera Krishnan", "West", "Laptop", 1, Decimal("1200.00"), D("2025-02-02"), "delivered"),
        ("Vikram Rao", "North", "Mouse", 5, Decimal("25.00"), D("2025-02-08"), "placed"),
        ("Nisha Menon", "North", "Monitor", 1, Decimal("300.00"), D("2025-02-14"), "cancelled")]


def revenue(df):
    return {r.region: (r.n, r.rev) for r in df.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("quantity") * F.col("unit_price")).alias("rev")).collect()}


def test_orders_end_to_end(spark, tmp_table):
    t = VersionedTable.create(spark, tmp_table("e2e"), SCHEMA, ["order_id"], identity="order_id",
                              identity_mode="BY DEFAULT")
    t.insert(spark.createDataFrame(ROWS, NO_ID))
    assert revenue(t.as_of(1)) == {"North": (2, Decimal("425.00")), "South": (2, Decimal("1800.00")),
                                   "West": (2, Decimal("1440.00"))}
    t.update({"status": F.lit("shipped")}, F.col("order_id") == 3)
    t.delete(F.col("order_id") == 6)
    src = spark.createDataFrame(
        [(1, "returned", None, None, None, None, None, None),
         (99, "placed", "Kavya Reddy", "West", "Tablet", 1, Decimal("450.00"), D("2025-03-01"))],
        "order_id long, status string, customer string, region string, product string, quantity int, "
        "unit_price decimal(10,2), order_date date")
    t.merge(src, ["order_id"], matched_update={"status": "s.status"},
            not_matched_insert={c: f"s.{c}" for c in NO_ID.fieldNames()})
    counts = {(r._commit_version, r._change_type): r.n for r in
              t.changes(1).groupBy("_commit_version", "_change_type").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {(1, "insert"): 6, (2, "update_preimage"): 1, (2, "update_postimage"): 1, (3, "delete"): 1,
                      (4, "insert"): 1, (4, "update_preimage"): 1, (4, "update_postimage"): 1}
    pairs = sorted((p.version, p.order_id, p.status_before, p.status_after)
                   for p in ch.change_pairs(t.changes(1), ["order_id"], ["status"]).collect())
    assert pairs == [(2, 3, "placed", "shipped"), (4, 1, "delivered", "returned")]
    diff = {r.order_id: r.change_type for r in ch.diff_versions(t.as_of(1), t.current(), ["order_id"]).collect()}
    assert diff == {1: "CHANGED", 2: "unchanged", 3: "CHANGED", 4: "unchanged", 5: "unchanged", 6: "REMOVED",
                    7: "ADDED"}

    # copies: delete North, recover from the copy with the original ids (needs BY DEFAULT)
    copy = t.clone(tmp_table("e2e-copy"))
    t.delete(F.col("region") == "North")
    t.commit(recover.recover_changes(t.current(), copy.current(), ["order_id"]), "MERGE")
    assert sorted(r.order_id for r in t.current().collect()) == [1, 2, 3, 4, 5, 7]
    t.insert(spark.createDataFrame([("Arjun Pillai", "West", "Headset", 2, Decimal("150.00"), D("2025-03-05"),
                                     "placed")], NO_ID))
    assert max(r.order_id for r in t.current().collect()) == 8      # continues after the high-water mark

    # evolve: discount 10 where quantity >= 3, else 0
    t.add_columns([T.StructField("discount", T.IntegerType())])
    t.update({"discount": F.when(F.col("quantity") >= 3, F.lit(10)).otherwise(F.lit(0))}, F.col("discount").isNull())
    disc = {r.customer: r.discount for r in t.current().collect()}
    assert disc["Rohan Iyer"] == 10 and disc["Vikram Rao"] == 10 and disc["Aarav Sharma"] == 0


def test_identity_always_blocks_recovery_with_ids(spark, tmp_table):
    t = VersionedTable.create(spark, tmp_table("always"), SCHEMA, ["order_id"], identity="order_id")
    t.insert(spark.createDataFrame(ROWS, NO_ID))
    copy = t.clone(tmp_table("always-copy"))
    t.delete(F.col("region") == "North")
    with pytest.raises(RuleViolation):
        t.commit(recover.recover_changes(t.current(), copy.current(), ["order_id"]), "MERGE")


def test_governed_customers(spark, tmp_table):
    def c(name, typ, comment):
        return T.StructField(name, typ, True, {"comment": comment})
    schema = T.StructType([c("customer_id", T.IntegerType(), "Surrogate key"), c("name", T.StringType(), "Full name"),
                           c("email", T.StringType(), "Contact email - personal data, restrict access"),
                           c("city", T.StringType(), "City"), c("tier", T.StringType(), "Loyalty tier"),
                           c("signup_date", T.DateType(), "Signup date")])
    t = VersionedTable.create(spark, tmp_table("customers"), schema, ["customer_id"])
    t.insert(spark.createDataFrame([(i, f"n{i}", f"n{i}@x.com", "Chennai", tier, D("2024-01-01"))
                                    for i, tier in enumerate(["gold", "silver", "gold", "bronze", "silver"], 1)],
                                   schema))
    assert t.schema().fields[2].metadata["comment"].startswith("Contact email")
    inv = govern.column_inventory(spark, {"customers": t.current()}, "demo_cat", "governance")
    pii = govern.pii_columns(inv, name_patterns=("%phone%",))            # found by its comment alone
    assert [r.column_name for r in pii.collect()] == ["email"]
    public = t.current().drop("email")
    assert public.columns == ["customer_id", "name", "city", "tier", "signup_date"]
    t.update({"tier": F.lit("gold")}, F.col("customer_id") == 4)
    assert t.as_of(1).where(F.col("customer_id") == 4).first().tier == "bronze"
    assert t.current().where(F.col("customer_id") == 4).first().tier == "gold"
