"""A key that holds a third of all change rows: results stay whole and the
plan cuts the hot key down before the exchange."""

from pyspark.sql import functions as F

from verlog.operators import changes as ch
from verlog.operators import dml


def hot_log(spark, n_cold=2000, hot_updates=1000):
    cold = spark.range(n_cold).select(F.col("id").alias("k"), F.lit(0).alias("v"),
                                      F.lit("insert").alias(ch.CHANGE_TYPE), F.lit(1).cast("long").alias(ch.COMMIT_VERSION))
    hot = spark.range(hot_updates).select(F.lit(-1).cast("long").alias("k"), F.col("id").cast("int").alias("v"),
                                          F.lit("update_postimage").alias(ch.CHANGE_TYPE),
                                          (F.col("id") + 2).alias(ch.COMMIT_VERSION))
    return cold.unionByName(hot).repartition(8)


def test_hot_key_as_of(spark):
    log = hot_log(spark)
    snap = ch.as_of(log, ["k"])
    rows = {r.k: r.v for r in snap.collect()}
    assert len(rows) == 2001 and rows[-1] == 999
    plan = snap._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_key_many_versions(spark):
    log = hot_log(spark)
    got = {r[ch.AS_OF]: r.v for r in ch.as_of_many(log, ["k"], [2, 500, 1001]).where(F.col("k") == -1).collect()}
    assert got == {2: 0, 500: 498, 1001: 999}


def test_null_merge_keys_never_match(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    src = spark.createDataFrame([(1, "x")] + [(None, f"n{i}") for i in range(50)], "k long, v string")
    out = dml.merge_changes(cur, src, ["k"], matched_update={"v": "s.v"}, not_matched_insert="*")
    kinds = {r[ch.CHANGE_TYPE]: r.n for r in out.groupBy(ch.CHANGE_TYPE).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kinds == {"update_preimage": 1, "update_postimage": 1, "insert": 50}


def test_restriction_gives_the_same_rows_at_any_size(spark):
    log = hot_log(spark, n_cold=300, hot_updates=50)
    touched = ch.touched_keys(log, ["k"], 1, 10)
    rows = []
    for limit in ("10485760", "-1"):  # broadcast and shuffled plans
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        rows.append(ch.as_of(ch.restrict_to(log, ["k"], touched), ["k"]).collect())
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(rows[0]) == 1 and rows[0] == rows[1]
