"""A Merkle manifest of a dataset: a root, and for every row the proof that it is part of it.

Rows are leaves. Within a group the leaves stand in order; each run of ``arity``
consecutive nodes becomes one node of the next level until one node, the group's
subroot, is left. The subroots in order of their groups are the leaves of one
more tree of the same kind, whose last node is the root.

Every level is a self-join of its nodes: a node in slot s of its run computes the
index of the run's slot-zero node (its own index less s), the slot-zero nodes
equijoin on it, and what they find beside them makes their parent. A join key holds
at most ``arity`` nodes, whatever the group's size, so a group with a third of all
rows spreads like any other. Upwards each level is an ``arity``-th of the one
before; downwards each node joins its parent and takes the parent's path, so
rows meet only the level just above them. The driver sees two scalars: the size of
the largest group and the root.

Positions come from a range partitioning by (group, order, digest) and one count
for each range and group, not from a window over a group.

Null in any field is a value of its own (``-``); a null group is a group, the first
one; null order values come first. Rows that are equal in every field are leaves of
their own, and as their digests agree, their order makes no difference. Rows equal
in group and order only stand by digest. An empty table has no rows and no root.
Columns to carry keep their values under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verlog.llm.common import others, partitions, put_away, q, stage

ARITY = 8


def field(value: Column) -> Column:
    """One field as it goes into a leaf: ``-`` for null, else its length in bytes, a colon, and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """The leaf of a row: SHA-256 over its fields, as lowercase hex."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    """Digests as the text that their parent hashes."""
    return F.concat_ws("", F.transform(digests, _hex))


def proof_digest(path: Column) -> Column:
    """SHA-256 over the siblings on ``path``, level by level, left to right."""
    beside = F.transform(path, lambda p: F.concat_ws("", F.transform(
        F.filter(p["run"], lambda _, j: j != p["slot"]), _hex)))
    return F.sha2(F.concat_ws("", beside), 256)


def folded_root(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` (hex) leads to with the siblings on ``path``."""
    return F.aggregate(path, leaf, lambda below, p: F.sha2(F.concat_ws("", F.transform(
        p["run"], lambda x, j: F.when(j == p["slot"], below).otherwise(_hex(x)))), 256))


def _positions(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``_i``, the place within ``_g`` by ``order``, and ``_n``, the size of ``_g``."""
    # The last key spreads rows that are equal in all others.
    rows = stage(rows.withColumn("_salt", F.monotonically_increasing_id()), f"{label}-rows")
    by = [F.col(c).asc_nulls_first() for c in ("_g", *order, "_salt")]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by).drop("_salt")
    # Written at once: a range numbered anew after a lost executor would be another range.
    dealt = stage(dealt.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()),
                  f"{label}-ranges")
    runs = dealt.groupBy("_g", "_range").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy("_g")  # a row for each range that has rows of the group
    before = F.sum("_rows").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("_g", "_range", (F.coalesce(before, F.lit(0)) - F.col("_from")).alias("_shift"),
                       F.sum("_rows").over(group).alias("_n"))
    return (dealt.join(runs, ["_g", "_range"]).withColumn("_i", F.col("_at") + F.col("_shift"))
            .drop("_range", "_at", "_shift"))


def _levels(nodes: DataFrame, arity: int, label: str) -> list[DataFrame]:
    """The levels above ``nodes`` (_g, _i, _n, _h): (_g, _i, _n, _h, _run), ``_run`` being the digests below a node."""
    largest = nodes.agg(F.max("_n")).first()[0] or 0
    levels = []
    while largest > 1:
        slot = F.col("_i") % arity
        open_ = nodes.where("_n > 1").select("_g", "_i", "_n", "_h")
        heads = open_.where(slot == 0)
        rest = open_.where(slot != 0).select("_g", (F.col("_i") - slot).alias("_i"),
                                             F.struct(slot.alias("slot"), F.col("_h").alias("h")).alias("_beside"))
        # At most ``arity`` rows a key; grouped where the join left them.
        runs = (heads.join(rest, ["_g", "_i"], "left").groupBy("_g", "_i", "_n", "_h")
                .agg(F.array_sort(F.collect_list("_beside")).alias("_beside")))
        run = F.concat(F.array("_h"), F.transform("_beside", lambda x: x["h"]))
        parents = runs.select("_g", F.expr(f"_i div {arity}").alias("_i"),
                              F.ceil(F.col("_n") / arity).cast("long").alias("_n"), run.alias("_run"))
        nodes = stage(parents.withColumn("_h", F.unhex(F.sha2(_joined(F.col("_run")), 256))), f"{label}-{len(levels)}")
        levels.append(nodes)
        largest = -(-largest // arity)
    return levels


_PATH = "array<struct<slot:long,run:array<binary>>>"


def _tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The last node of every group."""
    out = nodes.where("_n = 1").select("_g", "_h")
    for level in levels:
        out = out.unionByName(level.where("_n = 1").select("_g", "_h"))
    return out


def _with_path(nodes: DataFrame, levels: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with what ``above`` (_g, _path, ...) says of their group, ``_path`` being led on to the node itself."""
    said = [c for c in above.columns if c not in ("_g", "_path")]
    down = None
    for level in [*reversed(levels), nodes]:
        carried = [c for c in level.columns if c != "_g"]
        alone = level.where("_n = 1").join(above, "_g").select("_g", *carried, *said, "_path")
        if down is not None:
            up = down.select("_g", F.col("_i").alias("_up"), F.col("_run").alias("_up_run"), "_path", *said)
            step = F.struct((F.col("_i") % arity).alias("slot"), F.col("_up_run").alias("run"))
            below = level.where("_n > 1").withColumn("_up", F.expr(f"_i div {arity}")).join(up, ["_g", "_up"])
            alone = alone.unionByName(below.select("_g", *carried, *said, F.concat(F.array(step), "_path").alias("_path")))
        down = alone
    return down


def manifest(rows: DataFrame, fields: list[str], group: str, order: str, carry: list[str] | None = None,
             extra: dict[str, Column] | None = None, arity: int = ARITY) -> tuple[DataFrame, str | None]:
    """The manifest of ``rows`` and its root.

    A row for each input row: the columns ``carry`` (all, unless given), those of
    ``extra`` (made from the input before its other columns go), ``leaf`` and ``subroot``
    as lowercase hex, and ``path``: from the leaf upwards, its slot and the digests of
    its whole run, for ``proof_digest`` and ``folded_root``.
    """
    extra = extra or {}
    names = others(rows, ["leaf", "subroot", "path", *extra]) if carry is None else carry
    away, back = put_away(names)
    leaves = rows.select(
        *away, *[c.alias(f"_extra_{k}") for k, c in enumerate(extra.values())],
        F.coalesce(F.concat(F.lit("="), q(group)), F.lit("")).alias("_g"), q(order).alias("_o"),
        F.unhex(leaf_digest(*[q(c) for c in fields])).alias("_h"))
    placed = _positions(leaves, ["_o", "_h"], "manifest")
    levels = _levels(placed, arity, "manifest")

    # One more tree over the groups; its only group is the empty one.
    tops = _positions(_tops(placed, levels).select(F.lit("").alias("_g"), F.col("_g").alias("_name"), "_h"),
                      ["_name"], "manifest-top")
    top_levels = _levels(tops, arity, "manifest-top")
    root = _tops(tops, top_levels).first()
    ends = tops.select("_g").distinct().withColumn("_path", F.array().cast(_PATH))
    # Written, a row for each group, so that the rows' plan need not hold the tree of groups as well.
    above = stage(_with_path(tops, top_levels, ends, arity).select(
        F.col("_name").alias("_g"), F.col("_h").alias("_sub"), "_path"), "manifest-above")

    out = _with_path(placed, levels, above, arity).select(
        *back, *[F.col(f"_extra_{k}").alias(c) for k, c in enumerate(extra)], _hex(F.col("_h")).alias("leaf"),
        _hex(F.col("_sub")).alias("subroot"), F.col("_path").alias("path"))
    return out, root and root["_h"].hex()
