"""F2 / F3: identity, DML, merge, changed-only diff, evolution, CTAS, CHECK."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.operators import changes as ch
from verlog.operators.rules import RuleViolation
from verlog.sources.versioned import VersionedTable

# The rows below and their results are those of FIXTURES.md.
SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("customer", T.StringType(), False),
    T.StructField("product", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DecimalType(10, 2)),
    T.StructField("order_date", T.DateType()),
    T.StructField("status", T.StringType()),
])
NO_ID = T.StructType(SCHEMA.fields[1:])
D = dt.date.fromisoformat
ROWS = [
    ("Aarav Sharma", "Laptop", 1, Decimal("1200.00"), D("2025-01-10"), "delivered"),
    ("Priya Nair", "Monitor", 2, Decimal("300.00"), D("2025-01-12"), "shipped"),
    ("Rohan Iyer", "Keyboard", 3, Decimal("80.00"), D("2025-01-15"), "placed"),
    ("Meera Krishnan", "Laptop", 1, Decimal("1200.00"), D("2025-02-02"), "delivered"),
    ("Vikram Rao", "Mouse", 5, Decimal("25.00"), D("2025-02-08"), "placed"),
    ("Aarav Sharma", "Monitor", 1, Decimal("300.00"), D("2025-02-14"), "cancelled"),
]


def build_orders(spark, path):
    t = VersionedTable.create(spark, path, SCHEMA, ["order_id"], identity="order_id")
    t.insert(spark.createDataFrame(ROWS, NO_ID))
    t.update({"status": F.lit("shipped")},
             (F.col("status") == "placed") & (F.col("order_date") < F.lit("2025-02-01").cast("date")))
    t.delete(F.col("order_id") == 6)
    src = spark.createDataFrame([(1, "returned", None, None, None, None, None),
                                 (2, "delivered", None, None, None, None, None),
                                 (99, "placed", "Nisha Menon", "Tablet", 1, Decimal("450.00"), D("2025-03-01"))],
                                "order_id long, status string, customer string, product string, quantity int, "
                                "unit_price decimal(10,2), order_date date")
    t.merge(src, ["order_id"], matched_update={"status": "s.status"},
            not_matched_insert={"customer": "s.customer", "product": "s.product", "quantity": "s.quantity",
                                "unit_price": "s.unit_price", "order_date": "s.order_date", "status": "s.status"})
    return t


@pytest.fixture(scope="module")
def orders(spark):
    """The F2 history (versions 0-4), shared read-only by the tests below."""
    import uuid
    from verlog.session import work_root
    return build_orders(spark, f"{work_root(spark)}/verlog-tests/orders-{uuid.uuid4().hex}")


@pytest.fixture
def orders_copy(orders, tmp_table):
    """A deep copy for tests that write (history from 0; ids keep counting)."""
    return orders.clone(tmp_table("orders-copy"))


def test_identity_in_insert_order(orders):
    v1 = sorted((r.order_id, r.customer, r.status) for r in orders.as_of(1).collect())
    assert [r[0] for r in v1] == [1, 2, 3, 4, 5, 6]
    assert v1[0][1] == "Aarav Sharma" and v1[4][1] == "Vikram Rao"


def test_merge_generates_new_id(orders):
    cur = {r.order_id: (r.customer, r.status) for r in orders.current().collect()}
    assert cur[7] == ("Nisha Menon", "placed")       # generated id, not the source's 99
    assert 99 not in cur and 6 not in cur
    assert cur[1][1] == "returned" and cur[2][1] == "delivered" and cur[3][1] == "shipped"


def test_changed_only_diff(orders):
    d = ch.diff_versions(orders.as_of(1), orders.current(), ["order_id"], ["status"], changed_only=True)
    got = sorted(((r.order_id or 0), r.status_old, r.status_new) for r in d.collect())
    assert got == [(1, "delivered", "returned"), (2, "shipped", "delivered"), (3, "placed", "shipped"),
                   (6, "cancelled", None), (7, None, "placed")]


def test_restore_and_evolve_and_ctas(spark, tmp_table):
    orders = build_orders(spark, tmp_table("orders-restore"))
    orders.restore(1)
    assert sorted(r.order_id for r in orders.current().collect()) == [1, 2, 3, 4, 5, 6]
    orders.add_columns([T.StructField("region", T.StringType())])
    assert orders.current().where(F.col("region").isNotNull()).count() == 0
    orders.update({"region": F.when(F.col("customer").isin("Aarav Sharma", "Vikram Rao"), F.lit("South"))
                   .otherwise(F.lit("West"))}, F.col("region").isNull())
    reg = {r.order_id: r.region for r in orders.current().collect()}
    assert reg == {1: "South", 5: "South", 6: "South", 2: "West", 3: "West", 4: "West"}
    # the version before the column was added does not have it
    assert "region" not in orders.as_of(5).columns
    summary = {r.customer: (r.orders, r.total_revenue, r.last_order) for r in
               orders.current().groupBy("customer").agg(
                   F.count(F.lit(1)).alias("orders"),
                   F.sum(F.col("quantity") * F.col("unit_price")).alias("total_revenue"),
                   F.max("order_date").alias("last_order")).collect()}
    assert summary["Aarav Sharma"] == (2, Decimal("1500.00"), D("2025-02-14"))
    assert summary["Rohan Iyer"] == (1, Decimal("240.00"), D("2025-01-15"))


def test_check_constraint(orders_copy, spark):
    orders = orders_copy
    orders.add_check("positive_quantity", "quantity > 0")
    before = orders.version()
    bad = spark.createDataFrame([("X", "Y", 0, Decimal("1.00"), D("2025-03-02"), "placed")], NO_ID)
    with pytest.raises(RuleViolation):
        orders.insert(bad)
    assert orders.version() == before
    nullq = spark.createDataFrame([("X", "Y", None, Decimal("1.00"), D("2025-03-02"), "placed")], NO_ID)
    orders.insert(nullq)                                 # NULL passes a CHECK
    assert orders.version() == before + 1


def test_not_null_and_schema(orders_copy, spark):
    orders = orders_copy
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in NO_ID.fields])
    bad = spark.createDataFrame([(None, "Y", 1, Decimal("1.00"), D("2025-03-02"), "placed")], loose)
    with pytest.raises(RuleViolation):
        orders.insert(bad)
    extra = spark.createDataFrame([("Z", "Y", 1, Decimal("1.00"), D("2025-03-02"), "placed", "x")],
                                  T.StructType([*NO_ID.fields, T.StructField("unexpected", T.StringType())]))
    with pytest.raises(RuleViolation):
        orders.insert(extra)


def test_identity_always_refuses_explicit_ids(orders_copy, spark):
    orders = orders_copy
    rows = spark.createDataFrame([(50, "A", "B", 1, Decimal("1.00"), D("2025-03-03"), "placed")], SCHEMA)
    with pytest.raises(RuleViolation):
        orders.insert(rows)


def test_duplicate_merge_source_refused(orders_copy, spark):
    orders = orders_copy
    from verlog.operators.dml import DuplicateSourceKeys
    src = spark.createDataFrame([(1, "a"), (1, "b")], "order_id long, status string")
    with pytest.raises(DuplicateSourceKeys):
        orders.merge(src, ["order_id"], matched_update={"status": "s.status"})
