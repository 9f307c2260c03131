"""DML as functions: each returns the *change rows* a statement emits.

Nothing is written or run here; ``VersionedTable.commit`` appends the rows as one version. Every function reads the current snapshot once: update and merge
emit both images from a single pass with ``explode`` instead of a union that
would recompute the snapshot.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verlog.operators.changes import CHANGE_TYPE, DELETE, INSERT, POSTIMAGE, PREIMAGE


def _as_col(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.expr(v)
    return F.lit(v)


def _pred(p) -> Column:
    """A predicate where NULL means "no match" (``coalesce(p, false)``)."""
    if p is None:
        return F.lit(True)
    return F.coalesce(_as_col(p), F.lit(False))


def insert_changes(rows: DataFrame) -> DataFrame:
    return rows.withColumn(CHANGE_TYPE, F.lit(INSERT))


def delete_changes(current: DataFrame, predicate) -> DataFrame:
    """``DELETE FROM t WHERE p``: rows where p is TRUE become delete rows."""
    return current.where(_pred(predicate)).withColumn(CHANGE_TYPE, F.lit(DELETE))


def update_changes(current: DataFrame, assignments: Mapping[str, object], predicate=None,
                   keys: Sequence[str] = ()) -> DataFrame:
    """``UPDATE t SET c = e, ... WHERE p``: a preimage and a postimage per matched row.

    Assignments are evaluated against the old row (all at once, like SQL). A row
    whose key (of ``keys``) changes is a delete of the old and an insert of the new one.
    """
    unknown = set(assignments) - set(current.columns)
    if unknown:
        raise ValueError(f"UPDATE sets unknown columns: {sorted(unknown)}")
    matched = current.where(_pred(predicate))
    pair = F.array(F.lit(PREIMAGE), F.lit(POSTIMAGE))
    moved = [k for k in keys if k in assignments]
    if moved:
        same = F.lit(True)
        for k in moved:
            same = same & F.col(k).eqNullSafe(_as_col(assignments[k]).cast(current.schema[k].dataType))
        pair = F.when(same, pair).otherwise(F.array(F.lit(DELETE), F.lit(INSERT)))
    images = matched.withColumn(CHANGE_TYPE, F.explode(pair))
    post = F.col(CHANGE_TYPE).isin(POSTIMAGE, INSERT)
    out = []
    for c in current.columns:
        if c in assignments:
            new = _as_col(assignments[c]).cast(current.schema[c].dataType)
            out.append(F.when(post, new).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return images.select(*out, CHANGE_TYPE)


class DuplicateSourceKeys(ValueError):
    pass


#: What a merge says, while it runs, of a source that matches a row twice.
TWICE = "merge source matches a target row more than once"


def merge_changes(current: DataFrame, source: DataFrame, on: str | Sequence[str],
                  matched_update: Mapping[str, object] | None = None,
                  not_matched_insert: Mapping[str, object] | str | None = None,
                  check_source: bool = True) -> DataFrame:
    """``MERGE INTO t USING s ON t.k = s.k`` with the clauses the reference uses.

    * ``matched_update``: ``{target_col: expr}``; expressions may name source
      columns as ``s.<col>`` and target columns as ``t.<col>``.
    * ``not_matched_insert``: ``"*"`` (insert the source row as is) or
      ``{target_col: expr}``; target columns left out are NULL (an identity
      column is then filled at commit).

    A source that matches a target row twice fails the job that runs the merge: hits are
    counted by a window over the source's keys, whose partitioning the join goes on
    with, so the source is not read for a check of its own. ``check_source=False``
    is for a source with unique keys, such as a version of a table.

    Source rows with a NULL key never match; they are split off before the join
    so they cannot pile into one shuffle partition.
    """
    on = [on] if isinstance(on, str) else list(on)
    tcols = current.columns
    scols = source.columns
    t = current.select(*[F.col(c).alias(f"t.{c}") for c in tcols], F.lit(True).alias("_t_hit"))
    s = source.select(*[F.col(c).alias(f"s.{c}") for c in scols])
    key_null = F.lit(False)
    for k in on:
        key_null = key_null | F.col(f"`s.{k}`").isNull()
    s_keyed = s.where(~key_null)
    s_null = s.where(key_null)
    once = F.lit(True)
    if check_source and matched_update is not None:
        s_keyed = s_keyed.withColumn("_s_rows", F.count(F.lit(1)).over(Window.partitionBy(*[F.col(f"`s.{k}`") for k in on])))
        once = F.col("_s_rows") == 1
    cond = None
    for k in on:
        c = F.col(f"`s.{k}`") == F.col(f"`t.{k}`")
        cond = c if cond is None else cond & c

    def ref(expr):
        if isinstance(expr, Column):
            return expr
        if isinstance(expr, str):
            return F.expr(_quote_refs(expr, tcols, scols))
        return F.lit(expr)

    def insert_row(named: bool = True) -> list[Column]:
        cols = []
        for c in tcols:
            if not_matched_insert == "*":
                e = F.col(f"`s.{c}`") if c in scols else F.lit(None)
            elif c in not_matched_insert:
                e = ref(not_matched_insert[c])
            else:
                e = F.lit(None)
            e = e.cast(current.schema[c].dataType)
            cols.append(e.alias(c) if named else e)
        return cols

    parts: list[DataFrame] = []
    if matched_update is not None and not_matched_insert is not None:
        joined = s_keyed.join(t, cond, "left")
        hit = F.col("_t_hit").isNotNull()
        kinds = (F.when(hit & ~once, F.raise_error(F.lit(TWICE)).cast("array<string>"))
                 .when(hit, F.array(F.lit(PREIMAGE), F.lit(POSTIMAGE))).otherwise(F.array(F.lit(INSERT))))
        ex = joined.withColumn(CHANGE_TYPE, F.explode(kinds))
        parts.append(ex.select(*_image_cols(current, matched_update, ref, insert_row(named=False)), CHANGE_TYPE))
    elif matched_update is not None:
        joined = s_keyed.join(t, cond, "inner")
        pair = F.when(~once, F.raise_error(F.lit(TWICE)).cast("array<string>")).otherwise(
            F.array(F.lit(PREIMAGE), F.lit(POSTIMAGE)))
        ex = joined.withColumn(CHANGE_TYPE, F.explode(pair))
        parts.append(ex.select(*_image_cols(current, matched_update, ref, None), CHANGE_TYPE))
    if not_matched_insert is not None:
        if matched_update is None:
            missing = s_keyed.join(t, cond, "left_anti")
            parts.append(missing.select(*insert_row(), F.lit(INSERT).alias(CHANGE_TYPE)))
        parts.append(s_null.select(*insert_row(), F.lit(INSERT).alias(CHANGE_TYPE)))
    if not parts:
        raise ValueError("merge needs a matched or a not-matched clause")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merged(current: DataFrame, source: DataFrame, on: str | Sequence[str],
           matched_update: Mapping[str, object] | None = None, insert: bool = False) -> DataFrame:
    """The table as a merge leaves it, in one join: for previews, with a source of unique keys.

    ``matched_update`` as in ``merge_changes``; ``insert`` adds the source rows that match nothing as they are."""
    on = [on] if isinstance(on, str) else list(on)
    cols = current.columns
    if matched_update is None:
        missing = source.select(*cols).join(current.select(*on), on, "left_anti")
        return current.unionByName(missing.select(*cols))
    t = current.select(*[F.col(c).alias(f"t.{c}") for c in cols], F.lit(True).alias("_t_hit"))
    s = source.select(*[F.col(c).alias(f"s.{c}") for c in source.columns], F.lit(True).alias("_s_hit"))
    cond = functools.reduce(lambda a, b: a & b, [F.col(f"`t.{k}`") == F.col(f"`s.{k}`") for k in on])
    out = []
    for c in cols:
        kept = F.col(f"`t.{c}`")
        if c in matched_update:
            new = matched_update[c]
            new = F.expr(_quote_refs(new, cols, source.columns)) if isinstance(new, str) else _as_col(new)
            kept = F.when(F.col("_s_hit"), new.cast(current.schema[c].dataType)).otherwise(kept)
        if insert:
            kept = F.when(F.col("_t_hit"), kept).otherwise(F.col(f"`s.{c}`"))
        out.append(kept.alias(c))
    return t.join(s, cond, "full" if insert else "left").select(*out)


def _image_cols(current: DataFrame, matched_update, ref, insert_cols):
    """Per target column: preimage = old, postimage = assignment, insert = source."""
    ct = F.col(CHANGE_TYPE)
    out = []
    for i, c in enumerate(current.columns):
        old = F.col(f"`t.{c}`")
        post = ref(matched_update[c]).cast(current.schema[c].dataType) if c in matched_update else old
        e = F.when(ct == F.lit(PREIMAGE), old).when(ct == F.lit(POSTIMAGE), post)
        if insert_cols is not None:
            e = e.otherwise(insert_cols[i])
        out.append(e.alias(c))
    return out


def _quote_refs(expr: str, tcols, scols) -> str:
    """Turn ``s.col`` / ``t.col`` in a SQL expression into the joined names; text in quotes stays."""

    def sub(m):
        return m.group(0) if m.group(1) is None else f"`{m.group(1)}.{m.group(2)}`"

    return re.sub(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|\b([st])\.([A-Za-z_][A-Za-z0-9_]*)\b""", sub, expr)
