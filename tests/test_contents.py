"""Table contents under ordinary use: two handles, repeated and missing keys, moved keys, repeated OPTIMIZE."""

import pytest
from pyspark.sql import functions as F

from verlog.operators import dml
from verlog.operators.rules import RuleViolation
from verlog.sources.versioned import VersionedTable

SCHEMA = "k string, n int"


@pytest.fixture
def new(spark, tmp_table):
    def make(*rows):
        t = VersionedTable.create(spark, tmp_table("contents"), spark.createDataFrame([], SCHEMA).schema, ["k"])
        if rows:
            t.insert(spark.createDataFrame(list(rows), SCHEMA))
        return t

    return make


def rows(t):
    return sorted(tuple(r) for r in t.current().collect())


def test_two_handles(spark, new):
    a = new(("A", 1))
    b = VersionedTable(spark, a.path)
    assert b.version() == 1
    a.insert(spark.createDataFrame([("B", 2)], SCHEMA))
    b.insert(spark.createDataFrame([("C", 3)], SCHEMA))
    a.refresh()
    assert rows(a) == rows(b) == [("A", 1), ("B", 2), ("C", 3)] and a.version() == 3


@pytest.mark.parametrize("bad", [[("Z", 1), ("Z", 2)], [(None, 1)], [("A", 9)]])
def test_inserts_refused(spark, new, bad):
    t = new(("A", 1))
    with pytest.raises(RuleViolation):
        t.insert(spark.createDataFrame(bad, SCHEMA))
    assert rows(t) == [("A", 1)] and t.version() == 1
    t.insert(spark.createDataFrame([("B", 2)], SCHEMA))  # the refused rows left nothing behind
    assert rows(t) == [("A", 1), ("B", 2)]


def test_key_update_moves_the_row(spark, new):
    t = new(("A", 1), ("B", 2), ("C", 3))
    t.update({"k": F.lit("Z")}, F.col("k") == "A")
    assert rows(t) == [("B", 2), ("C", 3), ("Z", 1)]
    t.update({"k": F.when(F.col("k") == "B", "C").otherwise("B")}, F.col("k").isin("B", "C"))
    assert rows(t) == [("B", 3), ("C", 2), ("Z", 1)]
    with pytest.raises(RuleViolation):
        t.update({"k": F.lit("C")}, F.col("k") == "B")
    assert sorted(tuple(r) for r in t.as_of(1).collect()) == [("A", 1), ("B", 2), ("C", 3)]


def test_merge_sources(spark, new):
    t = new(("A", 1))
    twice = spark.createDataFrame([("A", 5), ("N", 6), ("N", 7)], SCHEMA)
    t.merge(twice, "k", matched_update={"n": "s.n"})  # what is repeated matches nothing
    assert rows(t) == [("A", 5)]
    with pytest.raises(RuleViolation):
        t.merge(twice, "k", not_matched_insert="*")
    with pytest.raises(dml.DuplicateSourceKeys):
        t.merge(twice.union(twice), "k", matched_update={"n": "s.n"})
    assert rows(t) == [("A", 5)]


def test_text_in_quotes_is_not_a_column():
    assert dml._quote_refs("concat('s.note ', s.n, \"t.k\")", [], []) == "concat('s.note ', `s.n`, \"t.k\")"


@pytest.mark.parametrize("by", [None, "n"])
def test_optimize_twice(spark, new, by):
    t = new(("A", 1), ("B", 2), ("C", 2))
    for handle in (t, t, VersionedTable(spark, t.path)):
        handle.optimize(zorder_by=by)
        assert rows(handle) == rows(t) == [("A", 1), ("B", 2), ("C", 2)]
    t.delete(F.col("k") == "B")
    t.optimize(zorder_by=by)
    assert rows(t) == [("A", 1), ("C", 2)] and t.as_of(1).count() == 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_single_load_is_read_without_a_window(spark, new, tmp_table):
    """A deep copy, and a table with one load, are plain scans; any later change brings the window back."""
    t = new(("A", 1), ("B", 2), ("C", 3))
    assert "Window" not in _plan(t.current()) and "Exchange" not in _plan(t.current())
    t.update({"n": F.col("n") * 10}, F.col("k") == "B")
    t.delete(F.col("k") == "C")
    assert "Window" in _plan(t.current()) and rows(t) == [("A", 1), ("B", 20)]
    c = t.clone(tmp_table("copy"))
    assert c.version() == 0 and "Window" not in _plan(c.as_of(0)) and "Exchange" not in _plan(c.as_of(0))
    assert rows(c) == [("A", 1), ("B", 20)]
    c.add_columns(spark.createDataFrame([], "x string").schema.fields)
    assert sorted(tuple(r) for r in c.current().collect()) == [("A", 1, None), ("B", 20, None)]
    with pytest.raises(RuleViolation):
        c.insert(spark.createDataFrame([("B", 5, "y")], "k string, n int, x string"))
    c.insert(spark.createDataFrame([("B2", 5, "y")], "k string, n int, x string"))
    assert sorted(tuple(r) for r in c.current().collect()) == [("A", 1, None), ("B", 20, None), ("B2", 5, "y")]
    assert rows(new()) == []
    s = t.clone(tmp_table("shallow"), shallow=True)
    s.insert(spark.createDataFrame([("D", 4)], SCHEMA))
    assert rows(s) == [("A", 1), ("B", 20), ("D", 4)]
