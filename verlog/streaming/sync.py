"""Structured Streaming over a change log: downstream copies and running totals.

The stream reads the table's history: a history row is written only after its
version's change rows have passed every rule, so rows of a refused or half-written
commit never reach a consumer. Each micro-batch takes the versions that its history
rows name and reads their folders of the change log. ``trigger(availableNow=True)``
processes what is there and stops, and the checkpoint lets the next run continue
from the same place.

A shallow copy's version 0 holds rows without change files of its own; its first
batch takes them from the source it is pinned to.

What a consumer keeps does not grow with the number of batches, and a replayed batch
writes the same again:

* ``stream_sync``: batches of change rows; every ``FOLD_EVERY`` of them are folded into the
  newest change per key (deletes included, so that an older change that comes late
  cannot bring a row back). The downstream table is the latest change per key over what
  was folded and the few batches after -- the same ``as_of`` rule as the source, so
  the order in which the file source lists commits does not matter.
* ``stream_totals``: after each batch the counts and sums by group, the state before it plus
  the batch (insert/postimage add, delete/preimage subtract); readers take the newest.

What has been superseded is removed one step later, so that a run that died half
way finds what it needs.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.operators.changes import (CHANGE_TYPE, COMMIT_TIMESTAMP, COMMIT_VERSION, DELETE, PREIMAGE, as_of,
                                      newest_changes)
from verlog.sources.versioned import CLONE_SOURCE, COMMITS_SCHEMA, VersionedTable, delete_path, list_children, path_exists

#: Versions that one micro-batch takes at most.
COMMITS_PER_BATCH = 64
#: Batches of a downstream copy that are read before they are folded.
FOLD_EVERY = 8


def _log_schema(row_schema: T.StructType, *more: T.StructField) -> T.StructType:
    return T.StructType([*row_schema.fields,
                         T.StructField(CHANGE_TYPE, T.StringType()),
                         T.StructField(COMMIT_TIMESTAMP, T.TimestampType()),
                         T.StructField(COMMIT_VERSION, T.LongType()), *more])


def each_commit(table: VersionedTable, checkpoint: str, consume: Callable[[DataFrame, int], None],
                commits_per_batch: int = COMMITS_PER_BATCH) -> None:
    """Hands ``consume`` the change rows of versions committed since the last run, a micro-batch at a time."""
    spark, log = table.spark, _log_schema(table.schema())
    commits = (spark.readStream.schema(COMMITS_SCHEMA).option("maxFilesPerTrigger", str(int(commits_per_batch)))
               .parquet(table.commits_path))

    def batch_rows(batch: DataFrame, batch_id: int) -> None:
        versions = [r.version for r in batch.select("version").collect()]  # at most commits_per_batch
        folders = [f"{table.changes_path}/{COMMIT_VERSION}={v}" for v in versions]
        folders = [f for f in folders if path_exists(spark, f)]  # some versions change no rows
        parts = [spark.read.schema(log).option("basePath", table.changes_path).parquet(*folders)] if folders else []
        if 0 in versions and CLONE_SOURCE in table.properties(0):
            parts.append(table.log(upto=0, schema=table.schema()).select(*log.fieldNames()))
        if parts:
            consume(functools.reduce(DataFrame.unionByName, parts), batch_id)

    q = (commits.writeStream.foreachBatch(batch_rows).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _complete(spark: SparkSession, root: str) -> list[int]:
    """Numbers n of the finished folders ``root/n=<n>``, ascending."""
    names = [x for x in list_children(spark, root) if x.startswith("n=") and path_exists(spark, f"{root}/{x}/_SUCCESS")]
    return sorted(int(x[2:]) for x in names)


def _union(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    parts = [spark.read.schema(schema).parquet(p) for p in paths]
    return functools.reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def stream_sync(table: VersionedTable, target_path: str, checkpoint: str,
                commits_per_batch: int = COMMITS_PER_BATCH, fold_every: int = FOLD_EVERY) -> DataFrame:
    """Copy the change feed downstream incrementally; return the downstream table."""
    spark, log = table.spark, _log_schema(table.schema())
    batches, folded = f"{target_path}/batches", f"{target_path}/folded"

    def kept(upto: int | None = None) -> tuple[DataFrame, list[int], list[int]]:
        """What the copy consists of, with the numbers of its folds and of its batches after the newest fold."""
        folds = [n for n in _complete(spark, folded) if upto is None or n < upto]
        after = [n for n in _complete(spark, batches) if (not folds or n > folds[-1]) and (upto is None or n <= upto)]
        paths = [f"{folded}/n={n}" for n in folds[-1:]] + [f"{batches}/n={n}" for n in after]
        return _union(spark, paths, log), folds, after

    def consume(rows: DataFrame, n: int) -> None:
        rows.select(*log.fieldNames()).write.mode("overwrite").parquet(f"{batches}/n={n}")
        held, folds, after = kept(n)
        if len(after) >= fold_every:
            newest_changes(held, table.keys).write.mode("overwrite").parquet(f"{folded}/n={n}")
            # What the fold before this one covers is no longer needed by anyone.
            for old in folds[:-1]:
                delete_path(spark, f"{folded}/n={old}")
            for old in [m for m in _complete(spark, batches) if folds and m <= folds[-1]]:
                delete_path(spark, f"{batches}/n={old}")

    each_commit(table, checkpoint, consume, commits_per_batch)
    return as_of(kept()[0], table.keys, None, table.schema().fieldNames())


def signed(value: str | None = None):
    sign = F.when(F.col(CHANGE_TYPE).isin(DELETE, PREIMAGE), F.lit(-1)).otherwise(F.lit(1))
    return sign if value is None else sign * F.col(value)


def stream_totals(table: VersionedTable, group: str, value: str, target_path: str, checkpoint: str,
                  commits_per_batch: int = COMMITS_PER_BATCH) -> DataFrame:
    """Group counts and sums kept up to date from the change feed."""
    def partial(rows: DataFrame) -> DataFrame:
        return rows.groupBy(group).agg(F.sum(signed()).cast("long").alias("row_count"),
                                       F.sum(signed(value)).alias("value_sum"))

    spark = table.spark
    schema = partial(spark.createDataFrame([], _log_schema(table.schema()))).schema

    def consume(rows: DataFrame, n: int) -> None:
        before = [m for m in _complete(spark, target_path) if m < n]
        state = _union(spark, [f"{target_path}/n={m}" for m in before[-1:]], schema).unionByName(partial(rows))
        (state.groupBy(group).agg(F.sum("row_count").alias("row_count"), F.sum("value_sum").cast(schema["value_sum"].dataType)
                                  .alias("value_sum"))
         .write.mode("overwrite").parquet(f"{target_path}/n={n}"))
        for old in before[:-1]:
            delete_path(spark, f"{target_path}/n={old}")

    each_commit(table, checkpoint, consume, commits_per_batch)
    newest = _complete(spark, target_path)[-1:]
    return _union(spark, [f"{target_path}/n={m}" for m in newest], schema).where(F.col("row_count") != 0)
