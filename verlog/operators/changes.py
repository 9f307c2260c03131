"""Pure DataFrame operators over a change log.

A change log is a DataFrame holding the row columns plus three metadata
columns: ``_change_type`` (insert / delete / update_preimage /
update_postimage), ``_commit_version`` (long) and ``_commit_timestamp``.
Nothing here performs an action; every function returns a lazy DataFrame.

Scale notes
-----------
* ``as_of`` is one exchange by key. Spark inserts a window group limit on
  both sides of that exchange for ``row_number() = 1``, so a key that holds a
  third of all change rows is cut down to one row per map task before the
  shuffle.
* ``diff_versions`` joins two ``as_of`` frames that are already hash
  partitioned by key, so the full join adds no exchange of its own.
* ``change_pairs`` is a single aggregate by (key, version) instead of a
  self-join of the feed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
COMMIT_TIMESTAMP = "_commit_timestamp"
META_COLUMNS = (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP)

# The change-type names of the change feed.
INSERT = "insert"
DELETE = "delete"
PREIMAGE = "update_preimage"
POSTIMAGE = "update_postimage"


def row_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META_COLUMNS]


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def as_of(log: DataFrame, keys: str | Sequence[str], version: int | None = None,
          columns: Sequence[str] | None = None) -> DataFrame:
    """The table as it was at ``version``: newest non-preimage change per key,
    minus keys whose newest change is a delete."""
    keys = _keys(keys)
    live = log
    if version is not None:
        live = live.where(F.col(COMMIT_VERSION) <= F.lit(int(version)))
    live = live.where(F.col(CHANGE_TYPE) != F.lit(PREIMAGE))
    # A key that is deleted and inserted again in one version lives.
    newest = Window.partitionBy(*keys).orderBy(F.col(COMMIT_VERSION).desc(), F.col(CHANGE_TYPE) == F.lit(DELETE))
    cols = list(columns) if columns is not None else row_columns(log)
    return (
        live.withColumn("_rn", F.row_number().over(newest))
        .where((F.col("_rn") == 1) & (F.col(CHANGE_TYPE) != F.lit(DELETE)))
        .select(*cols)
    )


def newest_changes(log: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The newest change row of every key, deletes included: what ``as_of`` needs of a log's past."""
    newest = Window.partitionBy(*_keys(keys)).orderBy(F.col(COMMIT_VERSION).desc(), F.col(CHANGE_TYPE) == F.lit(DELETE))
    return (log.where(F.col(CHANGE_TYPE) != F.lit(PREIMAGE)).withColumn("_rn", F.row_number().over(newest))
            .where(F.col("_rn") == 1).drop("_rn"))


def as_of_base(base: DataFrame, delta: DataFrame, keys: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The table as it is after ``delta`` (change rows) on top of ``base`` (one row per key).

    The window runs over the delta only. Base rows that the delta leaves alone come
    through an unhinted anti-join: a delta that is small by measure is broadcast, and
    the base is then neither shuffled nor sorted."""
    keys = _keys(keys)
    touched = delta.where(F.col(CHANGE_TYPE) != F.lit(PREIMAGE)).select(*keys)
    return base.select(*columns).join(touched, keys, "left_anti").select(*columns).unionByName(
        as_of(delta, keys, None, columns))


def after_changes(current: DataFrame, changes: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """``current`` with one statement's change rows done to it: a preview of the version it would commit. A key has at
    most one new row among them, so there is no window; the join has no hint."""
    keys = _keys(keys)
    cols = current.columns
    touched = changes.where(F.col(CHANGE_TYPE) != F.lit(PREIMAGE)).select(*keys)
    new = changes.where(F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE)).select(*cols)
    return current.join(touched, keys, "left_anti").select(*cols).unionByName(new)


AS_OF = "_as_of"


def as_of_many(log: DataFrame, keys: str | Sequence[str], versions: Sequence[int],
               columns: Sequence[str] | None = None) -> DataFrame:
    """Several versions from one scan and one exchange.

    Each change row is fanned out to the requested versions it can serve
    (``v >= _commit_version``), then the newest row per (key, version) wins.
    The partial window group limit still runs before the exchange, per
    (key, version). Output: ``_as_of`` plus the row columns.
    """
    keys = _keys(keys)
    vs = sorted({int(v) for v in versions})
    cols = list(columns) if columns is not None else row_columns(log)
    targets = F.array(*[F.lit(v).cast("long") for v in vs])
    live = (log.where((F.col(COMMIT_VERSION) <= F.lit(vs[-1])) & (F.col(CHANGE_TYPE) != F.lit(PREIMAGE)))
            .withColumn(AS_OF, F.explode(F.filter(targets, lambda v: v >= F.col(COMMIT_VERSION)))))
    newest = Window.partitionBy(*keys, AS_OF).orderBy(F.col(COMMIT_VERSION).desc(), F.col(CHANGE_TYPE) == F.lit(DELETE))
    return (live.withColumn("_rn", F.row_number().over(newest))
            .where((F.col("_rn") == 1) & (F.col(CHANGE_TYPE) != F.lit(DELETE)))
            .select(AS_OF, *cols))


def change_feed(log: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """``table_changes(t, start[, end])``: change rows with start <= version <= end.
    Both bounds reach the scan as partition filters."""
    feed = log.where(F.col(COMMIT_VERSION) >= F.lit(int(start)))
    if end is not None:
        feed = feed.where(F.col(COMMIT_VERSION) <= F.lit(int(end)))
    return feed


def null_safe_differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when any pair differs (``IS DISTINCT FROM``)."""
    out = F.lit(False)
    for a, b in zip(left, right):
        out = out | ~a.eqNullSafe(b)
    return out


# The labels of the version diff report.
ADDED = "ADDED"
REMOVED = "REMOVED"
CHANGED = "CHANGED"
UNCHANGED = "unchanged"


def diff_versions(old: DataFrame, new: DataFrame, keys: str | Sequence[str],
                  compare: Sequence[str] | None = None, changed_only: bool = False) -> DataFrame:
    """Full outer join of two snapshots on the key, classified per key.

    Output: the key columns (coalesced), ``<c>_old`` / ``<c>_new`` for each
    compared column and ``change_type`` in ADDED / REMOVED / CHANGED /
    unchanged. ``changed_only`` drops the unchanged keys.
    """
    keys = _keys(keys)
    compare = list(compare) if compare is not None else [c for c in old.columns if c not in keys]
    o = old.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                   *[F.col(c).alias(f"{c}_old") for c in compare], F.lit(True).alias("_in_old"))
    n = new.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                   *[F.col(c).alias(f"{c}_new") for c in compare], F.lit(True).alias("_in_new"))
    joined = o.join(n, [f"_k_{k}" for k in keys], "full")
    differs = null_safe_differs([F.col(f"{c}_old") for c in compare], [F.col(f"{c}_new") for c in compare])
    kind = (
        F.when(F.col("_in_old").isNull(), F.lit(ADDED))
        .when(F.col("_in_new").isNull(), F.lit(REMOVED))
        .when(differs, F.lit(CHANGED))
        .otherwise(F.lit(UNCHANGED))
    )
    out = joined.select(*[F.col(f"_k_{k}").alias(k) for k in keys],
                        *[x for c in compare for x in (F.col(f"{c}_old"), F.col(f"{c}_new"))],
                        kind.alias("change_type"))
    if changed_only:
        out = out.where(F.col("change_type") != F.lit(UNCHANGED))
    return out


# The tags of the whole-row EXCEPT diff.
ONLY_OLD = "only in old"
ONLY_NEW = "only in new"


def diff_except(old: DataFrame, new: DataFrame) -> DataFrame:
    """Whole-row set difference both ways (distinct ``EXCEPT``), tagged.

    One aggregate over the union of both sides grouped by every column, instead
    of two anti-joins that would compute each side twice.
    """
    cols = old.columns
    both = old.select(*cols, F.lit(1).alias("_o"), F.lit(0).alias("_n")).unionByName(
        new.select(*cols, F.lit(0).alias("_o"), F.lit(1).alias("_n")))
    seen = both.groupBy(*cols).agg(F.max("_o").alias("_o"), F.max("_n").alias("_n"))
    return (seen.where(F.col("_o") != F.col("_n"))
            .select(F.when(F.col("_o") == 1, F.lit(ONLY_OLD)).otherwise(F.lit(ONLY_NEW)).alias("found_in"), *cols))


def change_pairs(feed: DataFrame, keys: str | Sequence[str], values: Sequence[str]) -> DataFrame:
    """Before and after of each update on one line, one aggregate by (key, version).

    Output: version, keys, ``<v>_before`` / ``<v>_after`` per value column.
    """
    keys = _keys(keys)
    updates = feed.where(F.col(CHANGE_TYPE).isin(PREIMAGE, POSTIMAGE))
    aggs = []
    for v in values:
        aggs.append(F.max(F.when(F.col(CHANGE_TYPE) == PREIMAGE, F.col(v))).alias(f"{v}_before"))
        aggs.append(F.max(F.when(F.col(CHANGE_TYPE) == POSTIMAGE, F.col(v))).alias(f"{v}_after"))
    return (updates.groupBy(F.col(COMMIT_VERSION).alias("version"), *keys).agg(*aggs))


def change_counts(feed: DataFrame) -> DataFrame:
    """Rows per version and change type, pivoted to one row per version."""
    return (
        feed.groupBy(F.col(COMMIT_VERSION).alias("version"))
        .agg(
            F.count_if(F.col(CHANGE_TYPE) == INSERT).alias("n_insert"),
            F.count_if(F.col(CHANGE_TYPE) == DELETE).alias("n_delete"),
            F.count_if(F.col(CHANGE_TYPE) == PREIMAGE).alias("n_preimage"),
            F.count_if(F.col(CHANGE_TYPE) == POSTIMAGE).alias("n_postimage"),
        )
    )


def touched_keys(log: DataFrame, keys: str | Sequence[str], after: int, upto: int) -> DataFrame:
    """Distinct keys with any change in versions ``(after, upto]`` (partition-pruned)."""
    keys = _keys(keys)
    return (log.where((F.col(COMMIT_VERSION) > F.lit(int(after))) & (F.col(COMMIT_VERSION) <= F.lit(int(upto))))
            .select(*keys).distinct())


def restrict_to(log: DataFrame, keys: str | Sequence[str], touched: DataFrame) -> DataFrame:
    """``log`` limited to the ``touched`` keys: a semi-join without a hint, so the
    planner broadcasts a small key set from its measured bytes and shuffles a large one."""
    return log.join(touched.select(*_keys(keys)), _keys(keys), "left_semi")


def changed_between(log: DataFrame, keys: str | Sequence[str], old: int, new: int,
                    columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Snapshots at ``old`` and ``new`` limited to the keys that can differ:
    those changed in ``(min, max]``. Cost follows the changes, not the table."""
    lo, hi = sorted((int(old), int(new)))
    part = restrict_to(log.where(F.col(COMMIT_VERSION) <= F.lit(hi)), keys, touched_keys(log, keys, lo, hi))
    return as_of(part, keys, old, columns), as_of(part, keys, new, columns)


def net_changes(current: DataFrame, target: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Change rows that turn ``current`` into ``target`` (used by restore).

    Columns compared are the union of both; a column missing on one side reads
    NULL. Keys only in ``current`` become deletes, keys only in ``target``
    inserts, keys whose rows differ a preimage/postimage pair.
    """
    keys = _keys(keys)
    cols = list(dict.fromkeys([*current.columns, *target.columns]))
    types = {f.name: f.dataType for f in target.schema}
    types.update({f.name: f.dataType for f in current.schema})

    def widen(df: DataFrame) -> DataFrame:
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None).cast(types[c])).alias(c) for c in cols])

    cur, tgt = widen(current), widen(target)
    non_keys = [c for c in cols if c not in keys]
    a = cur.select(*keys, F.struct(*non_keys).alias("_cur"))
    b = tgt.select(*keys, F.struct(*non_keys).alias("_tgt"))
    j = a.join(b, keys, "full")
    kinds = (
        F.when(F.col("_cur").isNull(), F.array(F.lit(INSERT)))
        .when(F.col("_tgt").isNull(), F.array(F.lit(DELETE)))
        .when(~F.col("_cur").eqNullSafe(F.col("_tgt")), F.array(F.lit(PREIMAGE), F.lit(POSTIMAGE)))
        .otherwise(F.array().cast("array<string>"))
    )
    exploded = j.select(*keys, "_cur", "_tgt", F.explode(kinds).alias(CHANGE_TYPE))
    use_cur = F.col(CHANGE_TYPE).isin(DELETE, PREIMAGE)
    return exploded.select(
        *[F.col(k) for k in keys],
        *[F.when(use_cur, F.col(f"_cur.{c}")).otherwise(F.col(f"_tgt.{c}")).alias(c) for c in non_keys],
        F.col(CHANGE_TYPE),
    ).select(*cols, CHANGE_TYPE)
