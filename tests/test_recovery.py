"""F4 / F3: restore, surgical repair, copies, recover, blue/green, rehearsal."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.operators import layout, recover
from verlog.sources.versioned import VersionedTable

# The rows below and their results are those of FIXTURES.md.
SCHEMA = T.StructType([
    T.StructField("payment_id", T.IntegerType()), T.StructField("customer", T.StringType()),
    T.StructField("region", T.StringType()), T.StructField("amount", T.DecimalType(10, 2)),
    T.StructField("paid_on", T.DateType()),
])
D = dt.date.fromisoformat
ROWS = [(1, "Aarav Sharma", "South", Decimal("1500.00"), D("2025-01-10")),
        (2, "Priya Nair", "South", Decimal("890.50"), D("2025-01-14")),
        (3, "Rohan Iyer", "West", Decimal("2400.00"), D("2025-01-20")),
        (4, "Meera Krishnan", "West", Decimal("650.75"), D("2025-02-02")),
        (5, "Vikram Rao", "North", Decimal("1100.00"), D("2025-02-11")),
        (6, "Nisha Menon", "North", Decimal("330.25"), D("2025-02-18"))]
EXPECTED = {"North": (2, Decimal("1430.25")), "South": (2, Decimal("2390.50")), "West": (2, Decimal("3050.75"))}


def region_totals(df):
    return {r.region: (r.n, r.total) for r in
            df.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total")).collect()}


@pytest.fixture
def payments(spark, tmp_table):
    t = VersionedTable.create(spark, tmp_table("payments"), SCHEMA, ["payment_id"])
    t.insert(spark.createDataFrame(ROWS, SCHEMA))
    return t


def test_full_restore(payments):
    assert region_totals(payments.current()) == EXPECTED
    good = payments.history().agg(F.max("version")).first()[0]
    assert good == 1
    payments.update({"amount": F.lit(0)})
    assert all(v[1] == 0 for v in region_totals(payments.current()).values())
    payments.restore(good)
    assert region_totals(payments.current()) == EXPECTED


def test_surgical_repair_keeps_later_rows(payments, spark):
    payments.update({"amount": F.lit(Decimal("1.00"))}, F.col("region") == "South")
    payments.insert(spark.createDataFrame([(7, "Kavya Reddy", "West", Decimal("980.00"), D("2025-03-01"))], SCHEMA))
    c = recover.surgical_repair_changes(payments.current(), payments.as_of(1), ["payment_id"],
                                        F.col("region") == "South", ["amount"])
    payments.commit(c, "MERGE")
    tot = region_totals(payments.current())
    assert tot["South"] == (2, Decimal("2390.50"))
    assert payments.current().count() == 7


def test_deep_copy_recover(payments, spark, tmp_table):
    payments.insert(spark.createDataFrame([(7, "Kavya Reddy", "West", Decimal("980.00"), D("2025-03-01"))], SCHEMA))
    copy = payments.clone(tmp_table("copy"))
    assert copy.version() == 0 and copy.current().count() == 7
    payments.delete(F.col("region") == "North")
    assert payments.current().count() == 5
    payments.commit(recover.recover_changes(payments.current(), copy.current(), ["payment_id"]), "MERGE")
    assert sorted(r.payment_id for r in payments.current().collect()) == [1, 2, 3, 4, 5, 6, 7]
    t = recover.totals({"live": payments.current(), "green": copy.current()}, "amount")
    assert {(r.relation, r.row_count, r.value_sum) for r in t.collect()} == {
        ("live", 7, Decimal("7851.50")), ("green", 7, Decimal("7851.50"))}
    assert recover.bluegreen_verdict(t).first().verdict == "PASS"


def test_rehearsal_on_copy(payments, tmp_table):
    copy = payments.clone(tmp_table("rehearse"))
    copy.delete(F.col("region") == "West")
    assert copy.current().count() == 4
    copy.restore(0)
    assert copy.current().count() == 6
    assert payments.current().count() == 6 and payments.version() == 1


def test_shallow_copy_pins_source(payments, tmp_table):
    shallow = payments.clone(tmp_table("shallow"), shallow=True)
    payments.delete(F.col("payment_id") == 1)
    assert shallow.current().count() == 6          # pinned at the source's version 1
    shallow.update({"region": F.lit("East")}, F.col("payment_id") == 2)
    assert payments.current().where(F.col("region") == "East").count() == 0
    assert shallow.current().where(F.col("region") == "East").count() == 1


def test_drops_ledger(spark):
    drops = spark.createDataFrame(
        [("a", dt.datetime(2025, 3, 1), None, True), ("b", dt.datetime(2025, 2, 1), None, True),
         ("c", dt.datetime(2025, 3, 2), None, False), ("d", dt.datetime(2025, 3, 2), dt.datetime(2025, 3, 3), True)],
        "table_name string, dropped_at timestamp, restored_at timestamp, managed boolean")
    got = [r.table_name for r in recover.recoverable_drops(drops, "2025-03-05 00:00:00").collect()]
    assert got == ["a"]


def test_retention_window(spark, payments):
    assert layout.retention_days("interval 30 days", 1) == 30
    h = payments.history()
    now = dt.datetime.now(dt.timezone.utc)
    r = layout.reachable_versions(h, now + dt.timedelta(days=10), payments.version(), 30, 7)
    assert {x.version: x.reachable for x in r.collect()} == {0: False, 1: True}


def test_swap_names(payments, spark, tmp_table):
    green = payments.clone(tmp_table("green"))
    green.update({"region": F.upper(F.col("region"))})
    live_path, retired = payments.path, tmp_table("retired")
    recover.swap_names(spark, live_path, green.path, retired)
    swapped = VersionedTable(spark, live_path)
    assert {r.region for r in swapped.current().collect()} == {"SOUTH", "WEST", "NORTH"}
    assert VersionedTable(spark, retired).current().count() == 6


def test_surgical_repair_reaches_rows_that_moved(payments, spark):
    """A damaged row whose region changed after the good version is still repaired
    (the merge target is every row with a source key)."""
    payments.update({"amount": F.lit(Decimal("1.00"))}, F.col("region") == "South")
    payments.update({"region": F.lit("East")}, F.col("payment_id") == 1)
    south_then = F.col("region") == "South"
    source = payments.rows_where(south_then, 1)
    c = recover.surgical_repair_changes(payments.rows_for_keys(source), source, ["payment_id"], south_then, ["amount"])
    payments.commit(c, "MERGE")
    cur = {r.payment_id: (r.region, r.amount) for r in payments.current().collect()}
    assert cur[1] == ("East", Decimal("1500.00")) and cur[2] == ("South", Decimal("890.50"))


def test_purge_plan(payments, spark):
    payments.update({"amount": F.lit(Decimal("2.00"))}, F.col("region") == "West")
    payments.snapshot(0)
    payments.snapshot()                       # base snapshot at version 2
    payments.delete(F.col("region") == "North")
    assert payments.purge_plan().count() == 0                 # everything is inside retention
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=10)
    plan = {(r.path.split("/")[-2], r.reason) for r in payments.purge_plan(later).collect()}
    reasons = {r for _, r in plan}
    assert reasons == {"covered by snapshot 2", "superseded by snapshot 2"}
    assert {p for p, _ in plan} >= {"_commit_version=1", "_commit_version=2", "version=0"}
    assert not any(p == "_commit_version=3" for p, _ in plan)  # the latest version stays
    assert sorted(r.payment_id for r in payments.current().collect()) == [1, 2, 3, 4]


def test_detail(payments):
    d = payments.detail().first()
    assert d.version == 1 and d.numFiles >= 1 and d.sizeInBytes > 0 and d["keys"] == "payment_id"


def test_drop_and_undrop(payments, spark, tmp_table):
    ledger = tmp_table("drops")
    before = sorted(payments.current().collect())
    recover.drop_table(spark, ledger, "payments", payments.path)
    assert not VersionedTable(spark, payments.path).exists()
    assert [r.table_name for r in recover.recoverable_drops(
        recover.drops_ledger(spark, ledger), dt.datetime.now(dt.timezone.utc)).collect()] == ["payments"]
    recover.undrop_table(spark, ledger, "payments")
    assert sorted(VersionedTable(spark, payments.path).current().collect()) == before
    assert recover.recoverable_drops(recover.drops_ledger(spark, ledger),
                                     dt.datetime.now(dt.timezone.utc)).count() == 0
    with pytest.raises(ValueError):
        recover.undrop_table(spark, ledger, "payments")


def _drop_tables(spark, sf, priorities):
    spark.createDataFrame([(i, 1, "O", Decimal("1.00"), D("2001-01-01"), p) for i, p in enumerate(priorities)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice decimal(18,2), o_orderdate date, "
                          "o_orderpriority string").write.parquet(f"{sf}/orders.parquet")
    at = dt.datetime(2025, 3, 5, tzinfo=dt.timezone.utc)
    spark.createDataFrame(
        [(1, at, "login"), (1, at - dt.timedelta(days=2), "error"), (2, at, "error"), (2, at, "signup"), (3, at, "error"),
         (4, at - dt.timedelta(days=9), "error")],
        "user_id long, ts timestamp, event_type string").write.parquet(f"{sf}/events.parquet")


@pytest.mark.parametrize("priorities, dropped", [
    (["1-URGENT", "2-HIGH", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None], {"orders_high": 7, "orders_low": 7}),
    (["1-URGENT", "5-LOW"], {"orders_low": 7}), ([], {})])
def test_recoverable_drops_of_both_ledgers(spark, tmp_table, priorities, dropped):
    from verlog.plans.catalog import QUERIES
    sf = tmp_table("drops-sf")
    _drop_tables(spark, sf, priorities)
    got = {r.table_name: r.days_left for r in QUERIES["recoverable_drops"](spark, sf).collect()}
    assert got == {**dropped, "table_1": 5}
