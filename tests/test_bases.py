"""Validity intervals and bucketed bases against versions kept in plain Python; purge and streams over them."""

import datetime as dt
import random
import shutil
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.operators import changes as ch
from verlog.operators import intervals as iv
from verlog.operators.rules import RuleViolation
from verlog.sources.versioned import VersionedTable, VersionError, path_exists
from verlog.streaming import sync

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("g", T.StringType()),
                       T.StructField("v", T.IntegerType())])


def rows(df, cols=("k", "g", "v")):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def play(spark, path, statements, properties=None):
    """A table and what each of its versions holds, by the statements' own meaning in Python."""
    t = VersionedTable.create(spark, path, SCHEMA, ["k"], properties=properties)
    states, now = [{}], {}
    for what, arg in statements:
        now = dict(now)
        if what == "insert":
            t.insert(spark.createDataFrame(arg, SCHEMA))
            now.update({r[0]: r for r in arg})
        elif what == "update":
            t.update({"v": F.col("v") + 100}, F.col("g") == arg)
            now = {k: (k, r[1], r[2] + 100) if r[1] == arg else r for k, r in now.items()}
        elif what == "delete":
            t.delete(F.col("g") == arg)
            now = {k: r for k, r in now.items() if r[1] != arg}
        elif what == "move":
            t.update({"k": F.col("k") + 1000}, F.col("k") == arg)
            if arg in now:
                r = now.pop(arg)
                now[arg + 1000] = (arg + 1000, *r[1:])
        elif what == "restore":
            t.restore(arg)
            now = dict(states[arg])
        states.append(now)
    return t, states


STATEMENTS = [("insert", [(i, "abcd"[i % 4], i) for i in range(12)]), ("update", "a"), ("delete", "b"),
              ("insert", [(20, "a", 1), (1, "b", 2)]), ("move", 4), ("update", "c"), ("restore", 2), ("delete", "d"),
              ("insert", [(30, "a", 7), (3, "d", 8)])]


@pytest.fixture(scope="module")
def played(spark, tmp_path_factory):
    return play(spark, str(tmp_path_factory.mktemp("bases") / "t"), STATEMENTS)


def check(t, states, versions=None):
    versions = list(range(len(states))) if versions is None else versions
    for v in versions:
        assert rows(t.as_of(v)) == sorted(states[v].values(), key=str), v
    many = t.as_of_many(versions)
    assert rows(many, ("_as_of", "k", "g", "v")) == sorted(((v, *r) for v in versions for r in states[v].values()), key=str)
    for a, b in [(versions[0], versions[-1]), (versions[-2], versions[1])]:
        want = sorted(((k, *(x[2] if x else None for x in (states[a].get(k), states[b].get(k))),
                        "ADDED" if k not in states[a] else "REMOVED" if k not in states[b] else
                        "CHANGED" if states[a][k][2] != states[b][k][2] else "unchanged")
                       for k in states[a].keys() | states[b].keys()), key=str)
        assert rows(t.diff(a, b, ["v"]), ("k", "v_old", "v_new", "change_type")) == want
        assert rows(t.diff(a, b, ["v"], changed_only=True), ("k", "change_type")) == [
            (r[0], r[3]) for r in want if r[3] != "unchanged"]
        x, y = set(states[a].values()), set(states[b].values())
        assert rows(t.diff_rows(a, b), ("found_in", "k", "g", "v")) == sorted(
            [("only in old", *r) for r in x - y] + [("only in new", *r) for r in y - x], key=str)
        before, after = (dict((r[0], r) for r in rows(df)) for df in t.changed_between(a, b))
        assert {k: r for k, r in states[a].items() if states[b].get(k) != r}.items() <= before.items()
        assert all(states[b].get(k) == r for k, r in after.items())


def test_without_a_base(played):
    t, states = played
    check(t, states)
    log = t.log()
    got = iv.intervals(log, ["k"], ["k", "g", "v"])
    for v in (1, 4, 5, 7, 9):
        assert rows(iv.holding(got, v)) == sorted(states[v].values(), key=str)


@pytest.mark.parametrize("at", [[4], [1, 5, 8, 9], [0, 7]])
def test_with_bases(spark, tmp_table, played, at):
    t, states = played
    copy = tmp_table("based")
    shutil.copytree(t.path, copy)
    c = VersionedTable(spark, copy)
    for v in at:
        assert c.base(v, buckets=3) == v
    assert c.base(at[0]) == at[-1]  # covered already
    check(c, states)
    c.restore(3)
    assert rows(c.current()) == sorted(states[3].values(), key=str)


def purge(t, days=40):
    plan = t.purge_plan(dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=days)).collect()
    for r in plan:
        shutil.os.remove(unquote(urlparse(r.path).path))
        folder = shutil.os.path.dirname(unquote(urlparse(r.path).path))
        if not [x for x in shutil.os.listdir(folder) if x.endswith(".parquet")]:
            shutil.rmtree(folder)
    return plan


@pytest.mark.parametrize("at", [[3, 8], [9]])
def test_reads_after_a_purge(spark, tmp_table, played, at):
    t, states = played
    copy = tmp_table("purged")
    shutil.copytree(t.path, copy)
    c = VersionedTable(spark, copy)
    for v in at:
        c.base(v, buckets=2)
    assert len(purge(c)) > 3
    c = VersionedTable(spark, copy)
    c.refresh()
    check(c, states)
    with pytest.raises(VersionError, match="purged"):
        c.changes(1)
    c.restore(2)
    assert rows(c.current()) == sorted(states[2].values(), key=str)
    c.base()
    check(c, [*states, states[2]])


def test_reads_after_a_purge_with_a_snapshot_only(spark, tmp_table):
    t, states = play(spark, tmp_table("snapped"), STATEMENTS[:3])
    t.snapshot(2)
    assert len(purge(t)) > 0
    t.refresh()
    assert rows(t.as_of(2)) == sorted(states[2].values(), key=str)
    many = rows(t.as_of_many([2, 3]), ("_as_of", "k", "g", "v"))
    assert many == sorted(((v, *r) for v in (2, 3) for r in states[v].values()), key=str)
    with pytest.raises(VersionError, match="purged"):
        t.as_of(1)
    t.restore(2)
    assert rows(t.current()) == sorted(states[2].values(), key=str)


def test_interval_property_and_new_columns(spark, tmp_table):
    t, states = play(spark, tmp_table("every"), STATEMENTS[:4], {"verlog.baseInterval": "2"})
    assert [b.version for b in t._bases()] == [4, 2]
    check(t, states)
    t.add_columns([T.StructField("note", T.StringType())])
    t.update({"note": F.lit("n")}, F.col("g") == "c")          # version 6: a base with the new column
    assert [b.version for b in t._bases()] == [6, 4, 2]
    want = sorted(((*r, "n" if r[1] == "c" else None) for r in states[4].values()), key=str)
    assert rows(t.current(), ("k", "g", "v", "note")) == want
    assert t.as_of(4).columns == ["k", "g", "v"] and rows(t.as_of(4)) == sorted(states[4].values(), key=str)
    t.restore(4)
    assert t.current().columns == ["k", "g", "v"] and rows(t.current()) == sorted(states[4].values(), key=str)
    t.update({"v": F.lit(0)}, F.col("g") == "c")               # version 8: a base after the column went
    assert rows(t.as_of(6), ("k", "g", "v", "note")) == want


def test_a_replacement_keeps_types(spark, tmp_table):
    t = VersionedTable.create(spark, tmp_table("retyped"), SCHEMA, ["k"])
    t.insert(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    with pytest.raises(VersionError, match="type"):
        t.replace_with(spark.createDataFrame([(1, "a", "x")], "k long, g string, v string"))
    assert rows(t.current()) == [(1, "a", 1)]


def exchanges_of_base(df):
    """Lines of the plan that deal out rows of a base."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines, inside = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        inside = [(d, e) for d, e in inside if d < depth]
        if "Exchange" in line and "Broadcast" not in line:
            inside.append((depth, line))
        if "verlog_states_" in line:
            lines += [e for _, e in inside]
    return lines


def test_plans_leave_the_base_where_it_is(spark, tmp_table, played):
    t, _ = played
    copy = tmp_table("planned")
    shutil.copytree(t.path, copy)
    c = VersionedTable(spark, copy)
    c.base(6, buckets=5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = spark.createDataFrame([(1, 5)], "k long, w int")
        for df in (c.as_of(3), c.as_of(6), c.current(), c.as_of_many([2, 5, 9]), c.states(), c.rows_for_keys(source)):
            assert "verlog_states_" in df._jdf.queryExecution().executedPlan().toString()
            assert exchanges_of_base(df) == []
        # What holds in both versions is not dealt either: only the branches that are filtered to what began or ended are.
        assert all("hashpartitioning" in e for e in exchanges_of_base(c.diff(1, 9, ["v"])))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_random_histories(spark, tmp_table):
    rnd = random.Random(8)
    for n in range(1):
        statements, used = [("insert", [(i, rnd.choice("abcd"), i) for i in range(20)])], 20
        for v in range(1, 9):
            kind = rnd.choice(["insert", "update", "delete", "move", "restore"])
            arg = {"insert": [(used + j, rnd.choice("abcd"), j) for j in range(3)], "move": rnd.randrange(used),
                   "restore": rnd.randrange(v + 1)}.get(kind, rnd.choice("abcd"))
            used += 3
            statements.append((kind, arg))
        t, states = play(spark, tmp_table(f"random{n}"), statements, {"verlog.baseInterval": "3"})
        check(t, states, [0, 1, 3, 5, 8, 9])


def test_base_of_a_shallow_copy(spark, tmp_table, played):
    t, states = played
    c = t.clone(tmp_table("shallow"), version=4, shallow=True)
    c.delete(F.col("g") == "a")
    want = sorted((r for r in states[4].values() if r[1] != "a"), key=str)
    c.base()
    assert rows(c.current()) == want and rows(c.as_of(0)) == sorted(states[4].values(), key=str)


# ---------------------------------------------------------------- streams
def test_stream_over_a_shallow_copy(spark, tmp_table, played):
    t, states = played
    c = t.clone(tmp_table("copy"), version=4, shallow=True)
    c.insert(spark.createDataFrame([(77, "a", 5)], SCHEMA))
    base = tmp_table("copied")
    out = sync.stream_sync(c, f"{base}/t", f"{base}/c", commits_per_batch=1)
    assert rows(out) == rows(c.current()) and len(rows(out)) == len(states[4]) + 1
    totals = sync.stream_totals(c, "g", "v", f"{base}/s", f"{base}/d", commits_per_batch=1)
    want = {r["g"]: (r["n"], r["s"]) for r in c.current().groupBy("g").agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()}
    assert {r["g"]: (r["row_count"], r["value_sum"]) for r in totals.collect()} == want


def test_downstream_does_not_grow_with_batches(spark, tmp_table, played):
    t, states = played
    base = tmp_table("folded")
    out = sync.stream_sync(t, f"{base}/t", f"{base}/c", commits_per_batch=1, fold_every=3)
    assert rows(out) == rows(t.current())
    assert len(sync._complete(spark, f"{base}/t/batches")) <= 6 and len(sync._complete(spark, f"{base}/t/folded")) <= 2
    totals = sync.stream_totals(t, "g", "v", f"{base}/s", f"{base}/d", commits_per_batch=1)
    assert len(sync._complete(spark, f"{base}/s")) == 2
    again = sync.stream_totals(t, "g", "v", f"{base}/s", f"{base}/d")
    assert rows(totals, ("g", "row_count", "value_sum")) == rows(again, ("g", "row_count", "value_sum"))
    want = t.current().groupBy("g").agg(F.count("*").alias("row_count"), F.sum("v").alias("value_sum"))
    assert rows(totals, ("g", "row_count", "value_sum")) == rows(want, ("g", "row_count", "value_sum"))


# ---------------------------------------------------------------- values and numbers
@pytest.mark.parametrize("kind,value", [("double", 1.9), ("string", "x"), ("bigint", 1 << 40), ("decimal(6,2)", None)])
def test_values_that_do_not_fit_are_refused(spark, tmp_table, kind, value):
    t = VersionedTable.create(spark, tmp_table("fit"), SCHEMA, ["k"])
    bad = spark.range(1).select(F.lit(1).cast("long").alias("k"), F.lit("a").alias("g"),
                                (F.lit("2.50") if value is None else F.lit(value)).cast(kind).alias("v"))
    with pytest.raises(RuleViolation, match="v"):
        t.insert(bad)
    assert t.version() == 0 and not path_exists(spark, f"{t.changes_path}/_commit_version=1")
    good = bad.withColumn("v", F.lit("2").cast(kind))
    t.insert(good)
    assert rows(t.current()) == [(1, "a", 2)]


def test_identity_follows_the_incoming_order(spark, tmp_table):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.LongType())])
    t = VersionedTable.create(spark, tmp_table("ids"), schema, ["id"], identity="id", identity_mode="BY DEFAULT")
    t.insert(spark.range(1000).select(F.col("id").alias("x")).repartitionByRange(7, "x").sortWithinPartitions("x"))
    assert rows(t.current(), ("id", "x")) == sorted(((x + 1, x) for x in range(1000)), key=str)
    t.insert(spark.createDataFrame([(5000, 1), (None, 2), (None, 3)], schema).coalesce(1))
    assert rows(t.changes(2), ("id", "x")) == [(1001, 2), (1002, 3), (5000, 1)]
    assert not path_exists(spark, f"{t.path}/_staging") or not [
        x for x in shutil.os.listdir(f"{t.path}/_staging") if not x.startswith(".")]
    t.insert(spark.createDataFrame([(9,)], "x long"))
    assert rows(t.changes(3), ("id", "x")) == [(5001, 9)]


def test_previews(spark, played):
    from verlog.operators import dml
    t, states = played
    cur = t.current()
    changes = dml.update_changes(cur, {"v": F.lit(-1)}, F.col("g") == "a", ["k"])
    assert rows(ch.after_changes(cur, changes, ["k"])) == sorted(((k, g, -1 if g == "a" else v) for k, g, v in states[9].values()), key=str)
    source = t.as_of(1)
    both = {**states[1], **states[9]}
    want = [(k, g, states[1][k][2] if k in states[1] and k in states[9] else v) for k, g, v in both.values()]
    assert rows(dml.merged(cur, source, "k", {"v": "s.v"}, insert=True)) == sorted(want, key=str)
    assert rows(dml.merged(cur, source, "k", insert=True)) == sorted(both.values(), key=str)
    assert rows(dml.merged(cur, source, "k", {"v": "s.v"})) == sorted((r for r in want if r[0] in states[9]), key=str)
