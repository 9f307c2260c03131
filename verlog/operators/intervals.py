"""Versions as validity intervals: each state of a row with the versions it holds for.

A state is a row with ``_valid_from`` (the version that wrote it) and ``_valid_to`` (the
first version it no longer holds in, NULL while it holds). Any version is then a
range filter of one relation, several versions are one scan of it, and two versions
differ only in states that end or begin between them: what holds in both is
unchanged without a join.

``intervals`` makes the relation from change rows with ``lead`` per key, one exchange.
A key has at most one state a version, so a window partition is bounded by the number
of versions, whatever the table's size. ``ended_by`` carries the relation forward:
states open at a base end at the first later change of their key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verlog.operators.changes import (ADDED, AS_OF, CHANGE_TYPE, CHANGED, COMMIT_VERSION, DELETE, INSERT, ONLY_NEW,
                                      ONLY_OLD, POSTIMAGE, PREIMAGE, REMOVED, UNCHANGED)

VALID_FROM = "_valid_from"
VALID_TO = "_valid_to"


def intervals(log: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The states that change rows tell of; the last one of a key that is not deleted stays open."""
    # A key deleted and inserted again in one version lives on from there.
    order = Window.partitionBy(*keys).orderBy(F.col(COMMIT_VERSION), F.col(CHANGE_TYPE) != DELETE)
    return (log.where(F.col(CHANGE_TYPE) != PREIMAGE).withColumn(VALID_TO, F.lead(COMMIT_VERSION).over(order))
            .where(F.col(CHANGE_TYPE) != DELETE)
            .select(*columns, F.col(COMMIT_VERSION).alias(VALID_FROM), VALID_TO))


def ended_by(open_states: DataFrame, delta: DataFrame, keys: Sequence[str], columns: Sequence[str],
             buckets: int) -> DataFrame:
    """Open states, each ended by the first change of its key in ``delta``. The join has no hint: few changed keys are
    broadcast by measure, many meet the states in their ``buckets``; the states stay where they are."""
    # Grouped as the states are bucketed: an aggregate with more partitions would draw the states to its own.
    ends = (delta.where(F.col(CHANGE_TYPE) != PREIMAGE).select(*keys, COMMIT_VERSION).repartition(buckets, *keys).groupBy(*keys)
            .agg(F.min(COMMIT_VERSION).alias(VALID_TO)))
    return (open_states.select(*columns, VALID_FROM).join(ends, list(keys), "left")
            .select(*columns, VALID_FROM, VALID_TO))


def _open_after(version: int):
    return F.col(VALID_TO).isNull() | (F.col(VALID_TO) > version)


def holding(states: DataFrame, version: int) -> DataFrame:
    """States that hold in ``version``."""
    return states.where((F.col(VALID_FROM) <= version) & _open_after(version))


def holding_in(states: DataFrame, versions: Sequence[int]) -> DataFrame:
    """A row for each of ``versions`` (``_as_of``) that a state holds in: one scan, no exchange."""
    wanted = F.array(*[F.lit(v).cast("long") for v in sorted({int(v) for v in versions})])
    served = F.filter(wanted, lambda v: (v >= F.col(VALID_FROM)) & (F.col(VALID_TO).isNull() | (v < F.col(VALID_TO))))
    return states.withColumn(AS_OF, F.explode(served)).drop(VALID_FROM, VALID_TO)


def only_in(states: DataFrame, version: int, other: int) -> DataFrame:
    """States that hold in ``version`` and not in ``other``."""
    held_then = (F.col(VALID_FROM) <= other) & _open_after(other)
    return holding(states, version).where(~held_then)


def in_both(states: DataFrame, version: int, other: int) -> DataFrame:
    """States that hold in both versions (and in all between them)."""
    return holding(holding(states, version), other)


def moved_between(states: DataFrame, old: int, new: int, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys whose state is not the same one in both versions: ``_old`` and ``_new``, structs of ``columns`` (NULL where the
    key is not there). One pass over the states and one aggregate by key of those that begin or end between the
    versions, two rows a key at most."""
    def holds(version: int):
        return (F.col(VALID_FROM) <= version) & _open_after(version)

    row = F.struct(*columns) if columns else F.struct(F.lit(True).alias("_there"))
    ends = states.withColumns({"_in_old": holds(old), "_in_new": holds(new)}).where(F.col("_in_old") != F.col("_in_new"))
    return ends.groupBy(*keys).agg(F.first(F.when(F.col("_in_old"), row), ignorenulls=True).alias("_old"),
                                   F.first(F.when(F.col("_in_new"), row), ignorenulls=True).alias("_new"))


def diff_states(states: DataFrame, old: int, new: int, keys: Sequence[str], compare: Sequence[str],
                lasting: DataFrame | None) -> DataFrame:
    """``changes.diff_versions`` of two versions: only the states that begin or end between them are brought together.
    ``lasting`` has the states that hold in both (maybe among others); without it only what changed is given."""
    moved = moved_between(states, old, new, keys, compare)
    kind = (F.when(F.col("_old").isNull(), ADDED).when(F.col("_new").isNull(), REMOVED)
            .when(~F.col("_old").eqNullSafe(F.col("_new")), CHANGED).otherwise(UNCHANGED))
    moved = moved.select(*keys, *[x for c in compare for x in (F.col(f"_old.{c}").alias(f"{c}_old"),
                                                               F.col(f"_new.{c}").alias(f"{c}_new"))],
                         kind.alias("change_type"))
    if lasting is None:
        return moved.where(F.col("change_type") != UNCHANGED)
    same = in_both(lasting, old, new).select(
        *keys, *[x for c in compare for x in (F.col(c).alias(f"{c}_old"), F.col(c).alias(f"{c}_new"))],
        F.lit(UNCHANGED).alias("change_type"))
    return same.unionByName(moved)


def except_states(states: DataFrame, old: int, new: int, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``changes.diff_except`` of two versions: whole rows of one that the other lacks. Keys are unique in a version,
    so a row can only equal the other version's row of its key."""
    rest = [c for c in columns if c not in keys]
    moved = moved_between(states, old, new, keys, rest).where(~F.col("_old").eqNullSafe(F.col("_new")))
    sides = F.array(F.struct(F.lit(ONLY_OLD).alias("found_in"), F.col("_old").alias("row")),
                    F.struct(F.lit(ONLY_NEW).alias("found_in"), F.col("_new").alias("row")))
    return (moved.select(*keys, F.inline(F.filter(sides, lambda s: s["row"].isNotNull())))
            .select("found_in", *[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in columns]))


def net_states(states: DataFrame, now: int, then: int, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Change rows that turn version ``now`` into version ``then`` (what a restore writes), as ``changes.net_changes``."""
    rest = [c for c in columns if c not in keys]
    moved = moved_between(states, now, then, keys, rest)
    before, after = F.col("_old").alias("row"), F.col("_new").alias("row")
    emitted = (F.when(F.col("_old").isNull(), F.array(F.struct(F.lit(INSERT).alias(CHANGE_TYPE), after)))
               .when(F.col("_new").isNull(), F.array(F.struct(F.lit(DELETE).alias(CHANGE_TYPE), before)))
               .when(~F.col("_old").eqNullSafe(F.col("_new")), F.array(F.struct(F.lit(PREIMAGE).alias(CHANGE_TYPE), before),
                                                                       F.struct(F.lit(POSTIMAGE).alias(CHANGE_TYPE), after))))
    return (moved.select(*keys, F.inline(emitted))
            .select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in columns], CHANGE_TYPE))


def totals_in(states: DataFrame, versions: Sequence[int], value: str) -> DataFrame:
    """Rows and sum of ``value`` in each of ``versions``: one scan of the states, one aggregate, no row for each version."""
    vs = sorted({int(v) for v in versions})
    holds = {v: (F.col(VALID_FROM) <= v) & _open_after(v) for v in vs}
    one = states.agg(*[x for v, there in holds.items() for x in (
        F.count_if(there).alias(f"n{v}"), F.sum(F.when(there, F.col(value))).alias(f"s{v}"))])
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(v).cast("long").alias(AS_OF), F.col(f"n{v}").alias("row_count"), F.col(f"s{v}").alias("value_sum")) for v in vs])))
