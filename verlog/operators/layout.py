"""Layout and retention: file facts, compaction, clustering, purge dry run.

File facts come from Spark itself: the ``binaryFile`` source lists files
(distributed listing, content not read) and the hidden ``_metadata`` column
tells which file each row came from. Both sides use ``_metadata``-style URL
paths so they can be joined.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from verlog.operators.ids import assign_ids


def file_inventory(spark: SparkSession, path: str | list[str], glob: str = "*.parquet") -> DataFrame:
    """``LIST`` / ``ls``: every data file under ``path`` (one or more roots) with
    size and time. Folders starting with ``_`` are hidden *below* a root by
    Spark's listing, so pass such folders as roots themselves."""
    roots = [path] if isinstance(path, str) else list(path)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(roots))
    # _metadata.file_path, not binaryFile's own path column: it is the same
    # URL-encoded form a row scan reports, so the two can be joined.
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("length"), F.col("modificationTime"))


#: Bytes of a compacted file.
TARGET_BYTES = 128 << 20


@contextmanager
def _packed_reads(spark: SparkSession, target: int) -> Iterator[None]:
    """While it holds, scans pack whole files into partitions of about ``target`` bytes, by their measured sizes."""
    wanted = {"spark.sql.files.maxPartitionBytes": str(target), "spark.sql.files.openCostInBytes": "0",
              "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def compact(spark: SparkSession, source: str, path: str, target: int = TARGET_BYTES) -> DataFrame:
    """``OPTIMIZE``: rewrite the files under ``source`` into files of about ``target`` bytes.

    Spark's own packing of files into scan partitions does the binning, and each partition is
    one written file: no shuffle, and the number of files follows the bytes at any size."""
    with _packed_reads(spark, int(target)):
        spark.read.parquet(source).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def group_hashes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of every group and an order-free hash of all their columns: equal for equal bags of rows."""
    cols = [F.col(c) for c in sorted(df.columns)]
    # Two sums of independent hashes; decimals do not overflow at any row count.
    parts = [F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (0, 1)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *parts)


#: Buckets of a column in a Z-value (a power of two).
Z_BUCKETS = 64


def z_value(df: DataFrame, columns: Sequence[str], buckets: int = Z_BUCKETS) -> Column:
    """The Z-value of a row: the buckets of its columns (by quantiles of ``df``, one aggregate; nulls first) with their
    bits interleaved, so that rows near in every column are near in it."""
    shares = [i / buckets for i in range(1, buckets)]
    exprs = [F.percentile_approx(_as_number(df, c), shares, 100 * buckets).alias(f"q{i}") for i, c in enumerate(columns)]
    bounds = df.agg(*exprs).first()  # buckets - 1 numbers a column
    z = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        place = F.lit(0)
        for b in bounds[i] or []:
            place = place + F.coalesce((_as_number(df, c) > F.lit(b)).cast("int"), F.lit(0))
        for bit in range(buckets.bit_length() - 1):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(columns) + i))
    return z


def _as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    return (F.unix_micros(value) if isinstance(kind, TimestampType) else value).cast("double")


def cluster(df: DataFrame, path: str, columns: Sequence[str], files: int) -> DataFrame:
    """``ZORDER BY (a, b)``: range-partition on the Z-value and write sorted by it, so that each file covers a narrow
    range of every column. Beside the Z-value a hash of the row decides the range, so rows of one
    heavy value fill as many files as they need instead of one."""
    salt = F.xxhash64(*[F.col(c) for c in df.columns])
    z = z_value(df, columns)
    (df.withColumns({"_z": z, "_salt": salt}).repartitionByRange(int(files), "_z", "_salt")
     .sortWithinPartitions("_z", *columns).drop("_z", "_salt").write.mode("overwrite").parquet(path))
    return df.sparkSession.read.parquet(path)


def file_ranges(df: DataFrame, column: str) -> DataFrame:
    """Per file: rows, and min and max of ``column`` (what row-group skipping uses)."""
    return (df.groupBy(F.col("_metadata.file_path").alias("path"))
            .agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"), F.count(F.lit(1)).alias("n")))


def skipping(df: DataFrame, column: str) -> DataFrame:
    """What an equality filter on ``column`` opens, over every value it has: one row with ``values``, ``files``, ``probes``
    (pairs of a value and a file whose range covers it) and ``largest_share`` (rows of the fullest file, of all rows).

    The values are numbered in order; a file's range covers as many of them as the numbers of its ends say."""
    ranks = assign_ids(df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct(), "rank",
                       order_by=["value"])
    low = ranks.select(F.col("value").alias("min_value"), F.col("rank").alias("first"))
    high = ranks.select(F.col("value").alias("max_value"), F.col("rank").alias("last"))
    covered = file_ranges(df, column).join(low, "min_value", "left").join(high, "max_value", "left")
    seen = covered.agg(F.count(F.lit(1)).alias("files"), F.sum(F.col("last") - F.col("first") + 1).alias("probes"),
                       (F.max("n") / F.sum("n")).alias("largest_share"))
    return seen.withColumn("values", F.lit(ranks.count()).cast("long"))


_INTERVAL = re.compile(r"^\s*(?:interval\s+)?(\d+)\s+days?\s*$", re.I)


def retention_days(value: str | None, default: int) -> int:
    """Parse ``'interval 30 days'`` (or ``'30 days'``)."""
    if not value:
        return default
    m = _INTERVAL.match(value)
    if not m:
        raise ValueError(f"retention must be 'interval <n> days', got {value!r}")
    return int(m.group(1))


# Default retention (days) of the log and of removed files.
LOG_RETENTION_DAYS = 30
FILE_RETENTION_DAYS = 7


def reachable_versions(history: DataFrame, now, latest: int, log_days: int = LOG_RETENTION_DAYS,
                       file_days: int = FILE_RETENTION_DAYS) -> DataFrame:
    """Which versions time travel can still reach: the window is the *smaller*
    of the log and file retention; the latest version is always reachable."""
    window = min(int(log_days), int(file_days))
    now_c = F.lit(now).cast("timestamp")
    return history.select(
        "version", "timestamp",
        ((F.col("timestamp") >= now_c - F.expr(f"INTERVAL {window} DAYS"))
         | (F.col("version") == F.lit(int(latest)))).alias("reachable"))


def purge_impact(clones: DataFrame, reachable: DataFrame) -> DataFrame:
    """Shallow copies whose pinned source version a purge would make unreadable.

    ``clones``: clone_name, kind, source_name, source_version.
    ``reachable``: source_name, version, reachable.
    """
    r = reachable.select("source_name", F.col("version").alias("source_version"), "reachable")
    return (clones.where(F.col("kind") == "SHALLOW")
            .join(r, ["source_name", "source_version"], "left")
            .select("clone_name", "source_name", "source_version",
                    F.when(F.coalesce(F.col("reachable"), F.lit(False)), F.lit("safe"))
                    .otherwise(F.lit("breaks")).alias("after_purge")))


def now_utc() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)
