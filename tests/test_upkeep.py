"""Compaction, clustering, replacing and access against plain Python."""

import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.operators import govern, layout
from verlog.sources.versioned import VersionedTable, VersionError

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.IntegerType())])


def files(spark, path):
    return [r.length for r in layout.file_inventory(spark, path).collect()]


def test_compaction_follows_bytes(spark, tmp_table):
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    small, out = tmp_table("small"), tmp_table("packed")
    rows.repartition(40).write.parquet(small)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    total, target = sum(files(spark, small)), 1 << 20
    packed = layout.compact(spark, small, out, target)
    sizes = files(spark, out)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert len(sizes) <= 2 * total // target + 1 and max(sizes) <= 1.5 * target
    assert layout.group_hashes(packed, []).first() == layout.group_hashes(rows, []).first()
    assert layout.group_hashes(rows.withColumn("x", F.reverse("x")), []).first() != layout.group_hashes(rows, []).first()
    assert len(files(spark, layout.compact(spark, small, tmp_table("one")).inputFiles()[0].rsplit("/", 1)[0])) == 1


def test_clustering_narrows_every_column_and_splits_a_heavy_value(spark, tmp_table):
    rows = spark.range(40_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 1000).alias("a"),
                                      F.expr("date_add(date'2020-01-01', cast(pmod(xxhash64(id, 1), 900) as int))").alias("d"),
                                      F.when(F.col("id") % 10 > 0, F.col("id") % 50).alias("n"))
    out = layout.cluster(rows, tmp_table("z"), ["a", "d", "n"], 12)
    assert sorted(out.select("id").collect()) == sorted(rows.select("id").collect())
    plain = tmp_table("plain")
    rows.repartition(12).write.parquet(plain)
    for c in ("a", "d"):
        got, was = layout.skipping(out, c).first(), layout.skipping(spark.read.parquet(plain), c).first()
        values = sorted(r[0] for r in rows.select(c).distinct().collect())
        ranges = [(r.min_value, r.max_value) for r in layout.file_ranges(out, c).collect()]
        assert got["values"] == len(values) and got.files == len(ranges)
        assert got.probes == sum(lo <= v <= hi for v in values for lo, hi in ranges) < was.probes
        assert got.largest_share < 2 / 12


def test_clustering_of_nothing_and_of_equal_rows(spark, tmp_table):
    rows = spark.createDataFrame([], "a long, b double")
    assert layout.cluster(rows, tmp_table("none"), ["a", "b"], 4).count() == 0
    same = spark.range(1000).select(F.lit(1).alias("a"), F.lit(None).cast("double").alias("b"))
    assert layout.cluster(same, tmp_table("same"), ["a", "b"], 4).count() == 1000


def test_replacing_a_clone(spark, tmp_table):
    t = VersionedTable.create(spark, tmp_table("src"), SCHEMA, ["k"])
    t.insert(spark.createDataFrame([(1, 1), (2, 2), (3, 3)], SCHEMA))
    t.update({"v": F.lit(9)}, F.col("k") == 2)
    path = tmp_table("dst")
    c = t.clone(path, version=1)
    with pytest.raises(VersionError, match="exists"):
        t.clone(path)
    with pytest.raises(VersionError, match="shallow"):
        t.clone(path, shallow=True, replace=True)
    c.insert(spark.createDataFrame([(4, 4)], SCHEMA))
    c = t.clone(path, replace=True)
    assert sorted(map(tuple, c.current().collect())) == [(1, 1), (2, 9), (3, 3)]
    assert sorted(map(tuple, c.as_of(1).collect())) == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert [r.operation for r in c.history().orderBy("version").collect()] == ["CLONE", "WRITE", "CREATE OR REPLACE TABLE CLONE"]
    # Only what differs was written.
    assert sorted(r._change_type for r in c.changes(2).collect()) == ["delete", "update_postimage", "update_preimage"]
    again = t.clone(tmp_table("fresh"), replace=True)
    assert again.version() == 0 and again.current().count() == 3


def test_access_by_inheritance(spark):
    rnd = random.Random(4)
    objects = [(c, s, o) for c, s, o in itertools.product("ab", "xy", "123")] + [("a", "x", "1")]
    grants = []
    for p in "pqrstu":
        for c in "abz":
            grants += [(p, "USE CATALOG", "CATALOG", c)] * rnd.randint(0, 1)
            grants += [(p, rnd.choice(["USE SCHEMA", "SELECT"]), "CATALOG", c)] * rnd.randint(0, 1)
            for s in "xy":
                grants += [(p, rnd.choice(["USE SCHEMA", "SELECT", "MODIFY"]), "SCHEMA", f"{c}.{s}") for _ in range(2)]
                grants += [(p, "SELECT", "TABLE", f"{c}.{s}.{rnd.randint(1, 3)}")]
    held = {(p, k, n) for p, k, _, n in grants}
    want = sorted({(p, f"{c}.{s}.{o}") for p in "pqrstu" for c, s, o in objects
                   if (p, "USE CATALOG", c) in held and any((p, "USE SCHEMA", n) in held for n in (c, f"{c}.{s}"))
                   and any((p, "SELECT", n) in held for n in (c, f"{c}.{s}", f"{c}.{s}.{o}"))})
    got = govern.access(spark.createDataFrame(grants, "principal string, privilege string, object_type string, object_name string"),
                        spark.createDataFrame(objects, "catalog string, schema string, object string"))
    assert sorted(map(tuple, got.collect())) == want and want
