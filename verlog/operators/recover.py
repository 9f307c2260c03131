"""Recovery: restore previews, surgical repair, copies, blue/green, drops ledger.

``VersionedTable`` commits these; the functions here are the lazy parts so a
caller can look at a repair before committing it (``preview``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verlog.operators import dml
from verlog.operators.changes import COMMIT_TIMESTAMP, COMMIT_VERSION, net_changes


def stage(log: DataFrame, changes: DataFrame, version: int) -> DataFrame:
    """``log`` plus ``changes`` as an uncommitted version (for previews and rehearsals)."""
    cols = [c for c in log.columns if c not in (COMMIT_VERSION, COMMIT_TIMESTAMP)]
    extra = changes.select(*[(F.col(c) if c in changes.columns else F.lit(None).cast(log.schema[c].dataType)).alias(c)
                             for c in cols],
                           F.lit(None).cast("timestamp").alias(COMMIT_TIMESTAMP),
                           F.lit(int(version)).cast("long").alias(COMMIT_VERSION))
    return log.unionByName(extra.select(*log.columns))


def restore_changes(current: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Compensating change rows that make ``current`` equal ``target``."""
    return net_changes(current, target, keys)


def surgical_repair_changes(current: DataFrame, old: DataFrame, keys: Sequence[str], where,
                            columns: Sequence[str]) -> DataFrame:
    """MERGE matched-only from an old version, restricted by ``where``: rows
    changed since keep their newer columns except ``columns``; rows added since
    are untouched."""
    source = old.where(F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False)))
    return dml.merge_changes(current, source, keys, matched_update={c: f"s.{c}" for c in columns})


def recover_changes(current: DataFrame, copy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE not-matched-only ``INSERT *`` from a copy: rows deleted since come
    back with their original keys."""
    return dml.merge_changes(current, copy, keys, not_matched_insert="*", check_source=False)


def totals(frames: Mapping[str, DataFrame], value: str) -> DataFrame:
    """One row per labelled relation: count and sum (blue/green and rehearsal
    checks). One union, one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"),
                    F.sum(F.col(value)).cast("decimal(38,2)").alias("value_sum"))
             .select(F.lit(label).alias("relation"), "row_count", "value_sum")
             for label, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bluegreen_verdict(totals_df: DataFrame) -> DataFrame:
    """PASS when every relation has the same count and sum."""
    return totals_df.agg(
        F.when((F.countDistinct("row_count") == 1) & (F.countDistinct("value_sum") <= 1), F.lit("PASS"))
        .otherwise(F.lit("FAIL")).alias("verdict"))


def recoverable_drops(drops: DataFrame, now: _dt.datetime | str, retention_days: int = 7) -> DataFrame:
    """Dropped managed tables still inside the undrop window.

    ``drops``: table_name, dropped_at, restored_at, managed.
    """
    now_c = F.lit(now).cast("timestamp")
    return (drops.where(F.col("managed") & F.col("restored_at").isNull()
                        & (F.col("dropped_at") >= now_c - F.expr(f"INTERVAL {int(retention_days)} DAYS")))
            .select("table_name", "dropped_at",
                    (F.lit(retention_days) - F.datediff(now_c, F.col("dropped_at"))).alias("days_left")))


DROPS_SCHEMA = ("table_name string, path string, dropped_at timestamp, restored_at timestamp, managed boolean, "
                "trash_path string")


def undrop(spark, ledger_path: str, table_name: str, at: _dt.datetime | None = None) -> None:
    """``UNDROP TABLE``: records the restore of the newest drop of ``table_name``."""
    at = at or _dt.datetime.now(_dt.timezone.utc)
    spark.createDataFrame([(table_name, None, None, at, None, None)], DROPS_SCHEMA) \
        .coalesce(1).write.mode("append").parquet(ledger_path)


def drops_ledger(spark, ledger_path: str) -> DataFrame:
    """One row per dropped table: its newest drop and whether it was restored since."""
    events = spark.read.schema(DROPS_SCHEMA).parquet(ledger_path)
    drops = events.where(F.col("dropped_at").isNotNull()).groupBy("table_name").agg(
        F.max_by(F.struct("path", "dropped_at", "managed", "trash_path"), F.col("dropped_at")).alias("d"))
    restores = events.where(F.col("restored_at").isNotNull()).groupBy("table_name") \
        .agg(F.max("restored_at").alias("restored_at"))
    return (drops.join(restores, "table_name", "left")
            .select("table_name", "d.path", "d.dropped_at",
                    F.when(F.col("restored_at") >= F.col("d.dropped_at"), F.col("restored_at")).alias("restored_at"),
                    "d.managed", "d.trash_path"))


def swap_names(spark, live_path: str, green_path: str, retired_path: str) -> None:
    """Blue/green swap: live -> retired, green -> live. Two renames (metadata
    only, no data copied); like ``ALTER TABLE RENAME`` twice, not atomic, so
    verify first (``totals`` + ``bluegreen_verdict``)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    live, green, retired = (jvm.org.apache.hadoop.fs.Path(p) for p in (live_path, green_path, retired_path))
    fs = live.getFileSystem(conf)
    if fs.exists(retired):
        raise ValueError(f"{retired_path} exists")
    if not fs.rename(live, retired):
        raise OSError(f"could not rename {live_path}")
    if not fs.rename(green, live):
        fs.rename(retired, live)  # put the live table back
        raise OSError(f"could not rename {green_path}")
    from verlog.sources.versioned import forget
    for p in (live_path, green_path, retired_path):
        forget(p)


def clones_ledger(copies: Mapping[str, "object"]) -> DataFrame:
    """``clones``(clone_name, kind, source_path, source_version) read from each
    copy's own version-0 history row (its CLONE parameters)."""
    parts = []
    for name, t in copies.items():
        h = t.history().where(F.col("version") == 0)
        p = F.col("operationParameters")
        parts.append(h.select(F.lit(name).alias("clone_name"),
                              F.when(p["shallow"] == "True", F.lit("SHALLOW")).otherwise(F.lit("DEEP")).alias("kind"),
                              p["source"].alias("source_path"), p["sourceVersion"].cast("long").alias("source_version")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


UNDROP_DAYS = 7


def drop_table(spark, ledger_path: str, table_name: str, path: str, managed: bool = True,
               at: _dt.datetime | None = None) -> str | None:
    """``DROP TABLE``. Managed: the folder is moved aside (a metadata-only
    rename) and the drop recorded, so ``undrop_table`` can bring it back within
    the window. External: only the ledger row; the files stay where they are."""
    at = at or _dt.datetime.now(_dt.timezone.utc)
    trash = None
    if managed:
        jvm = spark.sparkContext._jvm
        src = jvm.org.apache.hadoop.fs.Path(path)
        fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        trash = f"{path.rstrip('/')}.dropped-{int(at.timestamp() * 1000)}"
        if not fs.rename(src, jvm.org.apache.hadoop.fs.Path(trash)):
            raise OSError(f"could not drop {path}")
        from verlog.sources.versioned import forget
        forget(path)
    spark.createDataFrame([(table_name, path, at, None, managed, trash)], DROPS_SCHEMA) \
        .coalesce(1).write.mode("append").parquet(ledger_path)
    return trash


def undrop_table(spark, ledger_path: str, table_name: str, window_days: int = UNDROP_DAYS) -> str:
    """``UNDROP TABLE``: the newest drop of a managed table, inside the window,
    moved back to its path. Returns the path."""
    now = _dt.datetime.now(_dt.timezone.utc)
    live = recoverable_drops(drops_ledger(spark, ledger_path), now, window_days) \
        .where(F.col("table_name") == table_name)
    row = drops_ledger(spark, ledger_path).join(live.select("table_name"), "table_name").first()
    if row is None or not row.trash_path:
        raise ValueError(f"{table_name} is not a recoverable dropped managed table")
    jvm = spark.sparkContext._jvm
    dst = jvm.org.apache.hadoop.fs.Path(row.path)
    fs = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(dst):
        raise ValueError(f"{row.path} exists; drop or rename it first")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(row.trash_path), dst):
        raise OSError(f"could not undrop {table_name}")
    undrop(spark, ledger_path, table_name, now)
    return row.path
