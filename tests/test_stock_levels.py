"""versions, diff, feed, change pairs, restore (FIXTURES.md F1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.operators import changes as ch
from verlog.sources.versioned import VersionedTable, VersionError

# The rows below and their results are those of FIXTURES.md.
SCHEMA = T.StructType([
    T.StructField("sku", T.StringType()), T.StructField("warehouse", T.StringType()),
    T.StructField("quantity", T.IntegerType()), T.StructField("updated_on", T.DateType()),
])
D = dt.date.fromisoformat


@pytest.fixture
def stock(spark, tmp_table):
    t = VersionedTable.create(spark, tmp_table("stock"), SCHEMA, ["sku"])
    t.insert(spark.createDataFrame([
        ("SKU-100", "Chennai", 500, D("2025-01-05")), ("SKU-200", "Chennai", 120, D("2025-01-05")),
        ("SKU-300", "Bangalore", 300, D("2025-01-05")), ("SKU-400", "Bangalore", 45, D("2025-01-05"))], SCHEMA))
    t.update({"quantity": F.lit(95), "updated_on": F.lit(D("2025-01-20"))}, F.col("sku") == "SKU-200")
    t.update({"quantity": F.lit(250), "updated_on": F.lit(D("2025-02-01"))}, F.col("sku") == "SKU-400")
    t.delete(F.col("sku") == "SKU-300")
    t.insert(spark.createDataFrame([("SKU-500", "Mumbai", 80, D("2025-02-10"))], SCHEMA))
    return t


def totals(df):
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q")).first()
    return r.n, r.q


def test_versions(stock):
    assert stock.version() == 5
    expected = {1: (4, 965), 2: (4, 940), 3: (4, 1145), 4: (3, 845), 5: (4, 925)}
    for v, exp in expected.items():
        assert totals(stock.as_of(v)) == exp
    v1 = {r.sku: r.quantity for r in stock.as_of(1).collect()}
    assert v1["SKU-300"] == 300 and v1["SKU-200"] == 120


def test_feed_and_pairs(stock):
    feed = stock.changes(1)
    kinds = sorted((r._commit_version, r.sku, r._change_type) for r in feed.collect())
    assert len(kinds) == 10
    assert (4, "SKU-300", "delete") in kinds and (5, "SKU-500", "insert") in kinds
    pairs = ch.change_pairs(feed, ["sku"], ["quantity"]).orderBy("version").collect()
    assert [(p.version, p.sku, p.quantity_before, p.quantity_after) for p in pairs] == [
        (2, "SKU-200", 120, 95), (3, "SKU-400", 45, 250)]


def test_diff(stock):
    d = {r.sku: r.change_type for r in
         ch.diff_versions(stock.as_of(1), stock.current(), ["sku"], ["quantity"]).collect()}
    assert d == {"SKU-100": "unchanged", "SKU-200": "CHANGED", "SKU-300": "REMOVED",
                 "SKU-400": "CHANGED", "SKU-500": "ADDED"}
    ex = {(r.found_in, r.sku, r.quantity) for r in ch.diff_except(stock.as_of(1), stock.current()).collect()}
    assert ex == {("only in old", "SKU-200", 120), ("only in old", "SKU-300", 300), ("only in old", "SKU-400", 45),
                  ("only in new", "SKU-200", 95), ("only in new", "SKU-400", 250), ("only in new", "SKU-500", 80)}


def test_restore_roundtrip(stock):
    stock.set_properties({"logRetentionDuration": "interval 30 days"})
    v1_rows = sorted(stock.as_of(1).collect())
    rv = stock.restore(1)
    assert rv == 7
    assert sorted(stock.current().collect()) == v1_rows
    kinds = {r._change_type: r.n for r in
             stock.changes(rv, rv).groupBy("_change_type").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kinds == {"insert": 1, "delete": 1, "update_preimage": 2, "update_postimage": 2}
    assert stock.restore(5) == 8
    assert sorted(stock.current().collect()) == sorted(stock.as_of(5).collect())
    ops = [r.operation for r in stock.history().orderBy("version").collect()]
    assert ops[6:] == ["SET TBLPROPERTIES", "RESTORE", "RESTORE"]


def test_timestamp_bounds(stock):
    h = {r.version: r.timestamp for r in stock.history().collect()}
    assert stock.version_at(h[3].astimezone(dt.timezone.utc)) == 3
    with pytest.raises(VersionError):
        stock.version_at(dt.datetime(2000, 1, 1))
    with pytest.raises(VersionError):
        stock.version_at(dt.datetime(2100, 1, 1))


def test_snapshot_read_is_same(stock):
    before = sorted(stock.as_of(5).collect())
    stock.snapshot(3)
    assert sorted(stock.as_of(5).collect()) == before
    assert totals(stock.as_of(4)) == (3, 845)


def test_unknown_version_raises(stock):
    with pytest.raises(VersionError):
        stock.as_of(42)


def test_snapshot_interval(spark, tmp_table):
    t = VersionedTable.create(spark, tmp_table("snap"), SCHEMA, ["sku"], properties={"verlog.snapshotInterval": "2"})
    for i in range(4):
        t.insert(spark.createDataFrame([(f"S{i}", "W", i, D("2025-01-01"))], SCHEMA))
    from verlog.sources.versioned import list_children
    assert sorted(list_children(spark, t.snapshots_path)) == ["version=2", "version=4"]
    assert totals(t.as_of(3)) == (3, 3) and totals(t.current()) == (4, 6)


def test_restore_drops_later_column_for_good(stock):
    stock.add_columns([T.StructField("note", T.StringType())])
    stock.update({"note": F.lit("recount")}, F.col("sku") == "SKU-100")
    stock.restore(5)
    assert "note" not in stock.current().columns
    stock.add_columns([T.StructField("note", T.StringType())])
    assert stock.current().where(F.col("note").isNotNull()).count() == 0
    assert totals(stock.current()) == (4, 925)


def test_optimize_zorder_keeps_results(stock, spark):
    from verlog.operators import layout
    before = sorted(stock.current().collect())
    v = stock.optimize(zorder_by="warehouse", files=2)
    assert v == stock.version()
    assert sorted(stock.current().collect()) == before
    snap = spark.read.parquet(f"{stock.snapshots_path}/version={v}")
    ranges = layout.file_ranges(snap, "warehouse").collect()
    assert all(r.min_value <= r.max_value for r in ranges)
    assert len({(r.min_value, r.max_value) for r in ranges}) == len(ranges)   # files do not overlap


def test_keyless_table_refused(spark, tmp_table):
    with pytest.raises(VersionError):
        VersionedTable.create(spark, tmp_table("nokey"), SCHEMA, [])


def test_replace_with_keeps_history(stock, spark):
    summary = stock.current().groupBy("warehouse").agg(F.sum("quantity").alias("units")) \
        .withColumnRenamed("warehouse", "sku")
    v = stock.replace_with(summary)
    assert sorted((r.sku, r.units) for r in stock.current().collect()) == [
        ("Bangalore", 250), ("Chennai", 595), ("Mumbai", 80)]
    assert stock.current().columns == ["sku", "units"]
    assert totals(stock.as_of(v - 1)) == (4, 925)


def test_snapshot_at_version_is_a_plain_scan(stock):
    before = sorted(stock.current().collect())
    stock.snapshot()
    cur = stock.current()
    assert sorted(cur.collect()) == before
    plan = cur._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
