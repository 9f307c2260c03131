"""Selective reads: candidate keys come from any matching change row, the
answer from the newest row only."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.operators import rules
from verlog.sources.versioned import VersionedTable

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("status", T.StringType()),
                       T.StructField("amount", T.IntegerType())])


def test_rows_where_uses_the_newest_row(spark, tmp_table):
    t = VersionedTable.create(spark, tmp_table("sel"), SCHEMA, ["k"])
    t.insert(spark.createDataFrame([(1, "O", 10), (2, "F", 20), (3, "O", 30)], SCHEMA))
    t.update({"status": F.lit("F")}, F.col("k") == 1)          # 1: O -> F
    t.update({"status": F.lit("O")}, F.col("k") == 2)          # 2: F -> O
    t.delete(F.col("k") == 3)                                  # 3 gone
    is_open = F.col("status") == "O"
    assert sorted(r.k for r in t.rows_where(is_open).collect()) == [2]
    assert sorted(r.k for r in t.rows_where(is_open, 1).collect()) == [1, 3]
    # the statements built on it agree with a full read
    t.update({"amount": F.col("amount") + 1}, is_open)
    assert {r.k: r.amount for r in t.current().collect()} == {1: 10, 2: 21}
    t.delete(F.col("amount") > 20)
    assert [r.k for r in t.current().collect()] == [1]


def test_conformance_counts_rows(spark):
    table = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("amount", T.DecimalType(10, 2))])
    batch = spark.createDataFrame([(1, "1.50", "x"), (2, "n/a", None), (3, None, "y")],
                                  "k long, amount string, extra string")
    got = {r.problem: r.rows_affected for r in rules.conformance(batch, table).collect()}
    assert got == {"unexpected column extra": 2, "column amount is string, table has decimal(10,2)": 1}


def test_reads_on_a_base(spark, tmp_table):
    """A base snapshot and a few later changes: same rows as the log alone, and the base is not exchanged."""
    def build(name):
        t = VersionedTable.create(spark, tmp_table(name), T.StructType([T.StructField(c, T.LongType()) for c in "kv"]), ["k"])
        t.insert(spark.range(2000).selectExpr("id AS k", "id % 7 AS v"))
        if name == "based":
            t.snapshot()
        t.add_columns([T.StructField("note", T.StringType())])
        t.update({"v": F.lit(-1), "note": F.lit("x")}, "k = 3")
        t.delete("k = 4")
        t.insert(spark.createDataFrame([(5000, 1, None)], "k long, v long, note string"))
        t.insert(spark.createDataFrame([(4, 9, "again")], "k long, v long, note string"))
        return t

    based, plain = build("based"), build("plain")
    keys = spark.createDataFrame([(3,), (4,), (5,), (9999,)], "k long")
    for version in (1, 3, 4, 6):
        assert sorted(based.as_of(version).collect(), key=str) == sorted(plain.as_of(version).collect(), key=str)
    for read in (lambda t: t.rows_where("v = 1"), lambda t: t.rows_where("note IS NULL AND k < 10"),
                 lambda t: t.rows_for_keys(keys)):
        assert sorted(read(based).collect(), key=str) == sorted(read(plain).collect(), key=str)
    plan = based.current()._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    based.restore(1)
    plain.restore(1)
    assert sorted(based.current().collect(), key=str) == sorted(plain.current().collect(), key=str)
