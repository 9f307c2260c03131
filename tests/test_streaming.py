"""T1 / T2: the change feed consumed as a stream equals the batch read."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.sources.versioned import VersionedTable
from verlog.streaming import sync

SCHEMA = T.StructType([T.StructField("sku", T.StringType()), T.StructField("warehouse", T.StringType()),
                       T.StructField("quantity", T.IntegerType())])


def test_stream_sync_and_totals(spark, tmp_table):
    t = VersionedTable.create(spark, tmp_table("feed"), SCHEMA, ["sku"])
    t.insert(spark.createDataFrame([("A", "W1", 5), ("B", "W1", 7), ("C", "W2", 1)], SCHEMA))
    base = tmp_table("sink")
    got = sync.stream_sync(t, f"{base}/t", f"{base}/cp", 1)
    assert sorted(got.collect()) == sorted(t.current().collect())
    t.update({"quantity": F.lit(9)}, F.col("sku") == "A")
    t.delete(F.col("sku") == "C")
    t.insert(spark.createDataFrame([("D", "W2", 4)], SCHEMA))
    # the same checkpoint continues where it stopped; replaying is harmless
    got = sync.stream_sync(t, f"{base}/t", f"{base}/cp", 1)
    assert sorted(got.collect()) == sorted(t.current().collect())
    again = sync.stream_sync(t, f"{base}/t", f"{base}/cp", 1)
    assert sorted(again.collect()) == sorted(t.current().collect())

    tot = sync.stream_totals(t, "warehouse", "quantity", f"{base}/g", f"{base}/gcp", 1)
    batch = t.current().groupBy("warehouse").agg(F.count(F.lit(1)).alias("row_count"),
                                                  F.sum("quantity").alias("value_sum"))
    assert sorted((r.warehouse, r.row_count, r.value_sum) for r in tot.collect()) == \
        sorted((r.warehouse, r.row_count, r.value_sum) for r in batch.collect())


def test_refused_batches_never_reach_the_copy(spark, tmp_table):
    t = VersionedTable.create(spark, tmp_table("feed"), SCHEMA, ["sku"])
    base = tmp_table("sink")
    assert sync.stream_sync(t, f"{base}/t", f"{base}/cp").collect() == []
    t.add_check("some", "quantity > 0")
    with pytest.raises(Exception, match="some"):
        t.insert(spark.createDataFrame([("X", "W1", -1)], SCHEMA))
    # What a writer leaves that died before its history row.
    orphan = spark.createDataFrame([("Y", "W1", 3, "insert")], "sku string, warehouse string, quantity int, _change_type string")
    orphan.withColumn("_commit_timestamp", F.current_timestamp()).write.mode("overwrite").parquet(
        f"{t.changes_path}/_commit_version={t.version() + 1}")
    assert sync.stream_sync(t, f"{base}/t", f"{base}/cp").collect() == []
    t.insert(spark.createDataFrame([("A", "W1", 5)], SCHEMA))
    assert [tuple(r) for r in sync.stream_sync(t, f"{base}/t", f"{base}/cp").collect()] == [("A", "W1", 5)]
