"""A versioned table held as an append-only change log of plain Parquet files.

Layout under the table path::

    _changes/_commit_version=<n>/part-*.parquet   change rows of version n
    _commits/version=<n>/part-*.parquet           one history row per version
    _snapshots/version=<b>/part-*.parquet          optional clustered snapshot at b (OPTIMIZE)
    _bases/version=<b>.buckets=<n>.<id>/_live=1/   states open at version b, bucketed by the key
                                       /_live=0/   states that ended since the base before

A base (``operators.intervals``) answers every version up to its own by a range filter and no
exchange, also after the change files below it are gone; later versions take its open
states and the changes since, which are dealt to its buckets.

A version exists once its history row exists: data first, history row last,
so readers never see a half-written version and a failed commit is retried
by overwriting the same partition (idempotent). One writer per table.

The history is metadata (one small row per version) and is read to the driver
for version lookups; change rows never are.
"""

from __future__ import annotations

import datetime as _dt
import functools
import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.operators import dml, rules
from verlog.operators.changes import (
    AS_OF, CHANGE_TYPE, COMMIT_TIMESTAMP, COMMIT_VERSION, DELETE, INSERT, POSTIMAGE, PREIMAGE, as_of, as_of_base, as_of_many,
    changed_between, net_changes, restrict_to,
)
from verlog.operators.ids import number_files
from verlog.operators.intervals import (
    VALID_FROM, VALID_TO, diff_states, ended_by, except_states, holding, holding_in, intervals, net_states, only_in,
)

COMMITS_SCHEMA = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("userName", T.StringType(), True),
    T.StructField("operation", T.StringType(), False),
    T.StructField("operationParameters", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("operationMetrics", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("schema_json", T.StringType(), False),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType()), True),
])

# Property names kept in every history row (the table's settings at that version).
KEYS_PROP = "verlog.keys"
IDENTITY_COL = "verlog.identity.column"
IDENTITY_MODE = "verlog.identity.mode"          # ALWAYS | BY DEFAULT
IDENTITY_HWM = "verlog.identity.highWaterMark"
CHECK_PREFIX = "verlog.constraints."
CLONE_SOURCE = "verlog.clone.source"
CLONE_VERSION = "verlog.clone.sourceVersion"
SNAPSHOT_INTERVAL = "verlog.snapshotInterval"  # write a snapshot every k versions
BASE_INTERVAL = "verlog.baseInterval"          # write a base every k versions
# Table property names a user of the reference sets (feed switch, retention).
FEED_ENABLED = "enableChangeDataFeed"
LOG_RETENTION = "logRetentionDuration"          # 'interval <n> days'
FILE_RETENTION = "deletedFileRetentionDuration"


#: Operations whose inserted rows may meet a live key (the others insert only keys that a join found missing).
KEY_CHECKED = ("WRITE", "UPDATE", "MERGE")


class VersionError(ValueError):
    pass


class Base(NamedTuple):
    version: int
    buckets: int
    path: str


# path -> (names of committed version folders, history rows); see VersionedTable._rows
_HISTORY: dict[str, tuple[frozenset, list]] = {}
# (path, read schema, latest version, session) -> DataFrame over _changes
_READS: dict[tuple, DataFrame] = {}
# (path, version, history stamp, session) -> as_of DataFrame (committed versions never change)
_AS_OF: dict[tuple, DataFrame] = {}
# (path, version, history stamp, bases, schema, bounds, session) -> states DataFrame
_STATES: dict[tuple, DataFrame] = {}
# base folders known to be complete
_COMPLETE: set[str] = set()
#: Plans that a process keeps by table and version.
KEPT_PLANS = 64


def _keep(cache: dict, key: tuple, plan: DataFrame) -> None:
    while len(cache) >= KEPT_PLANS:
        cache.pop(next(iter(cache)))
    cache[key] = plan


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def list_stamped(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time) of the children of ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), int(s.getModificationTime())) for s in fs.listStatus(p)]


def forget(path: str) -> None:
    """Drop the process caches of a table (after it was moved or replaced)."""
    path = path.rstrip("/")
    _HISTORY.pop(path, None)
    for cache in (_READS, _AS_OF, _STATES):
        for k in [k for k in cache if k[0] == path]:
            cache.pop(k, None)


class VersionedTable:
    """Handle on one versioned table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._history_cache: list | None = None

    # ------------------------------------------------------------------ paths
    @property
    def changes_path(self) -> str:
        return f"{self.path}/_changes"

    @property
    def commits_path(self) -> str:
        return f"{self.path}/_commits"

    @property
    def snapshots_path(self) -> str:
        return f"{self.path}/_snapshots"

    # --------------------------------------------------------------- creation
    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
               properties: Mapping[str, str] | None = None, identity: str | None = None,
               identity_mode: str = "ALWAYS", checks: Mapping[str, str] | None = None,
               user: str | None = None, if_not_exists: bool = False) -> "VersionedTable":
        """``CREATE TABLE``: version 0, no rows. A key is required: every
        versioned read is "newest row per key" (EXCEPT-style diffs of plain
        DataFrames need none)."""
        if not keys:
            raise VersionError("a versioned table needs key columns")
        missing = [k for k in keys if k not in schema.fieldNames()]
        if missing:
            raise VersionError(f"key columns not in the schema: {missing}")
        t = cls(spark, path)
        if t.exists():
            if if_not_exists:
                return t
            raise VersionError(f"table already exists at {path}")
        props = {KEYS_PROP: ",".join(keys), FEED_ENABLED: "true", **(properties or {})}
        if identity:
            props[IDENTITY_COL] = identity
            props[IDENTITY_MODE] = identity_mode
            props[IDENTITY_HWM] = "0"
        for name, expr in (checks or {}).items():
            props[CHECK_PREFIX + name] = expr
        t._write_commit(0, "CREATE TABLE", {}, {}, schema, props, user)
        return t

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.commits_path}")

    # ---------------------------------------------------------------- history
    def _rows(self) -> list:
        """History rows (small metadata), cached per process.

        The cache is checked against a listing of ``_commits`` (one filesystem
        call, no Spark job); it is re-read only when a version was added.
        """
        if self._history_cache is None:
            names = frozenset(x for x in list_stamped(self.spark, self.commits_path) if x[0].startswith("version="))
            if not names:
                raise VersionError(f"no table at {self.path}")
            cached = _HISTORY.get(self.path)
            if cached is not None and cached[0] == names:
                self._history_cache = cached[1]
            else:
                rows = sorted(
                    self.spark.read.schema(COMMITS_SCHEMA).parquet(self.commits_path)
                    .select("version", "timestamp", "schema_json", "properties", "operationMetrics").collect(),
                    key=lambda r: r.version)
                _HISTORY[self.path] = (names, rows)
                self._history_cache = rows
        return self._history_cache

    def refresh(self) -> None:
        """Look at the table anew: another handle may have committed meanwhile."""
        self._history_cache = None

    def history(self) -> DataFrame:
        """``DESCRIBE HISTORY``: one row per committed version."""
        return self.spark.read.schema(COMMITS_SCHEMA).parquet(self.commits_path)

    def audit(self) -> DataFrame:
        """The history as an audit log: when and by whom, the commit time before (NULL for the first), and rows written,
        updated and deleted."""
        before = F.lag("timestamp").over(Window.orderBy("version"))  # a row for each version
        metric = F.col("operationMetrics")
        return self.history().select(
            "version", "timestamp", before.alias("timestamp_before"), "userName", "operation",
            *[F.coalesce(metric[m].cast("long"), F.lit(0)).alias(c) for c, m in
              (("rows_written", "numOutputRows"), ("rows_updated", "numUpdatedRows"), ("rows_deleted", "numDeletedRows"))])

    def described(self, version: int | None = None) -> DataFrame:
        """The rows of a version with its columns' comments in their metadata."""
        rows = self.as_of(version)
        return rows.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in self.schema(version).fields])

    def version(self) -> int:
        return int(self._rows()[-1].version)

    def first_version(self) -> int:
        return int(self._rows()[0].version)

    def _row(self, version: int | None):
        rows = self._rows()
        if version is None:
            return rows[-1]
        for r in rows:
            if r.version == version:
                return r
        raise VersionError(f"version {version} does not exist (table has {rows[0].version}..{rows[-1].version})")

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(json.loads(self._row(version).schema_json))

    def properties(self, version: int | None = None) -> dict[str, str]:
        return dict(self._row(version).properties or {})

    @property
    def keys(self) -> list[str]:
        return self.properties()[KEYS_PROP].split(",")

    def checks(self) -> dict[str, str]:
        return {k[len(CHECK_PREFIX):]: v for k, v in self.properties().items() if k.startswith(CHECK_PREFIX)}

    def version_at(self, timestamp) -> int:
        """Latest version committed at or before ``timestamp``; error outside the lifetime."""
        rows = self._rows()
        ts = _naive(timestamp)
        if ts < _from_spark(rows[0].timestamp):
            raise VersionError(f"timestamp {timestamp} is before the first commit ({rows[0].timestamp})")
        if ts > _from_spark(rows[-1].timestamp):
            raise VersionError(f"timestamp {timestamp} is after the latest commit ({rows[-1].timestamp})")
        return int(max(r.version for r in rows if _from_spark(r.timestamp) <= ts))

    # ------------------------------------------------------------------ reads
    def _read_changes(self, schema: T.StructType) -> DataFrame:
        full = T.StructType([*schema.fields,
                             T.StructField(CHANGE_TYPE, T.StringType()),
                             T.StructField(COMMIT_TIMESTAMP, T.TimestampType()),
                             T.StructField(COMMIT_VERSION, T.LongType())])
        # Committed partitions never change (append-only), so the file listing
        # behind one read can be reused until a version is added.
        key = (self.path, full.json(), _HISTORY[self.path][0] if self.path in _HISTORY else None,
               id(self.spark), self.spark.sparkContext.applicationId)
        df = _READS.get(key)
        if df is None:
            if not path_exists(self.spark, self.changes_path):
                df = self.spark.createDataFrame([], full)
            else:
                df = self.spark.read.schema(full).parquet(self.changes_path)
            _keep(_READS, key, df)
        return df

    def _snapshots(self) -> list[tuple[int, str]]:
        """(version, folder) of every snapshot, newest first; ``version=5.2`` is the third one of version 5."""
        names = [n for n in list_children(self.spark, self.snapshots_path) if n.startswith("version=")]

        def place(name: str) -> tuple[int, int]:
            version, _, again = name.split("=", 1)[1].partition(".")
            return int(version), int(again or 0)

        return [(place(n)[0], n) for n in sorted(names, key=place, reverse=True)]

    def _base(self, upto: int, schema: T.StructType | None = None) -> tuple[int, DataFrame | None]:
        """Newest base snapshot at or below ``upto`` (as insert rows), if any, read with
        ``schema``: columns added after the snapshot are NULL."""
        # Newest first; only probe for completeness until one is found.
        found = next(((b, name) for b, name in self._snapshots()
                      if b <= upto and path_exists(self.spark, f"{self.snapshots_path}/{name}/_SUCCESS")), None)
        if found is None:
            return -1, None
        best, name = found
        schema = schema or self.schema(best)
        rows = self.spark.read.schema(schema).parquet(f"{self.snapshots_path}/{name}")
        return best, rows.select(*schema.fieldNames(), F.lit(INSERT).alias(CHANGE_TYPE),
                                 F.lit(None).cast("timestamp").alias(COMMIT_TIMESTAMP),
                                 F.lit(best).cast("long").alias(COMMIT_VERSION))

    def log(self, upto: int | None = None, since: int | None = None, schema: T.StructType | None = None,
            use_snapshot: bool = False) -> DataFrame:
        """Committed change rows (``since <= version <= upto``), read with ``schema``."""
        upto = self.version() if upto is None else int(upto)
        schema = schema or self.schema(upto)
        lo = -1 if since is None else int(since) - 1
        base = None
        if use_snapshot and since is None:
            b, base = self._base(upto, schema)
            lo = max(lo, b)
        gone = self._gone(lo + 1, upto)
        if gone:
            raise VersionError(f"change files of versions {gone} have been purged")
        df = self._read_changes(schema).where(
            (F.col(COMMIT_VERSION) <= F.lit(upto)) & (F.col(COMMIT_VERSION) > F.lit(lo)))
        props = self.properties(upto)
        if CLONE_SOURCE in props and (since is None or int(since) <= 0) and base is None:
            src = VersionedTable(self.spark, props[CLONE_SOURCE])
            pinned = src.as_of(int(props[CLONE_VERSION]))
            base = pinned.select(*[(F.col(f.name) if f.name in pinned.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                                   for f in schema.fields],
                                 F.lit(INSERT).alias(CHANGE_TYPE), F.lit(None).cast("timestamp").alias(COMMIT_TIMESTAMP),
                                 F.lit(0).cast("long").alias(COMMIT_VERSION))
        if base is not None:
            df = base.select(*df.columns).unionByName(df)
        return df

    def as_of(self, version: int | None = None) -> DataFrame:
        """``t VERSION AS OF n`` (latest when None)."""
        v = self.version() if version is None else int(version)
        self._row(v)  # raises if unknown
        snaps = frozenset(n for n in list_children(self.spark, self.snapshots_path))
        newest = self._newest_base()
        key = (self.path, v, _HISTORY[self.path][0], snaps, newest, id(self.spark), self.spark.sparkContext.applicationId)
        cached = _AS_OF.get(key)
        if cached is not None:
            return cached
        schema = self.schema(v)
        b, base = self._base(v, schema)
        if newest and v <= newest.version and b < v:
            df = holding(self._recorded(schema, after=v), v).select(*schema.fieldNames())
        elif newest and b <= newest.version < v:
            df = as_of_base(self._states_of(newest, schema, live=True),
                            self.log(upto=v, since=newest.version + 1, schema=schema), self.keys, schema.fieldNames())
        elif b == v:
            # A snapshot of exactly this version already holds one row per key:
            # a plain scan, no window and no exchange.
            df = base.select(*schema.fieldNames())
        elif base is not None:
            df = as_of_base(base, self.log(upto=v, since=b + 1, schema=schema), self.keys, schema.fieldNames())
        elif (only := self._only_load(v)) is not None:
            # All rows came as inserts of one version, whose keys were checked: a plain scan.
            df = self.log(upto=v, since=only, schema=schema).select(*schema.fieldNames())
        else:
            df = as_of(self.log(upto=v, schema=schema), self.keys, None, schema.fieldNames())
        _keep(_AS_OF, key, df)
        return df

    def _only_load(self, upto: int) -> int | None:
        """The one version up to ``upto`` that wrote change rows, if it wrote inserts only: a commit gives a key to one
        row, and a deep copy starts from a state, so it holds each key once."""
        if CLONE_SOURCE in self.properties(upto):
            return None
        wrote = {int(r.version): r.operationMetrics or {} for r in self._rows() if r.version <= upto and _changed(r)}
        if len(wrote) != 1:
            return None
        (version, metrics), = wrote.items()
        return None if any(int(metrics.get(m) or 0) for m in ("numUpdatedRows", "numDeletedRows")) else version

    # ------------------------------------------------------------------ bases
    @property
    def bases_path(self) -> str:
        return f"{self.path}/_bases"

    def _bases(self) -> list[Base]:
        """Complete bases, newest first."""
        out = []
        for name in list_children(self.spark, self.bases_path):
            path = f"{self.bases_path}/{name}"
            if path not in _COMPLETE:
                if not path_exists(self.spark, f"{path}/_SUCCESS"):
                    continue
                _COMPLETE.add(path)
            version, buckets, _ = name.split(".")
            out.append(Base(int(version.split("=")[1]), int(buckets.split("=")[1]), path))
        return sorted(out, reverse=True)

    def _newest_base(self) -> Base | None:
        return next(iter(self._bases()), None)

    def _states_of(self, base: Base, schema: T.StructType, live: bool) -> DataFrame:
        """States of a base, open or ended ones, read by bucket; columns it does not have are NULL."""
        path = f"{base.path}/_live={int(live)}"
        wanted = [*schema.fields, T.StructField(VALID_FROM, T.LongType()), T.StructField(VALID_TO, T.LongType())]
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], T.StructType(wanted))
        name = f"verlog_states_{hashlib.sha1(path.encode()).hexdigest()[:20]}"
        if not self.spark.catalog.tableExists(name):
            kept = [*self._wide_schema(base.version).fields, *wanted[-2:]]
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet CLUSTERED BY ({keys}) "
                           f"SORTED BY ({keys}) INTO {base.buckets} BUCKETS LOCATION '{path}'")
        rows = self.spark.table(name)
        return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in wanted])

    def _wide_schema(self, upto: int) -> T.StructType:
        """Every column that some version up to ``upto`` has."""
        fields: dict[str, T.StructField] = {}
        for v in sorted((r.version for r in self._rows() if r.version <= upto), reverse=True):
            for f in self.schema(v).fields:
                if fields.setdefault(f.name, T.StructField(f.name, f.dataType)).dataType != f.dataType:
                    raise VersionError(f"column {f.name} changed its type: versions before that cannot share a base")
        return T.StructType(list(fields.values()))

    def _recorded(self, schema: T.StructType, after: int = -1) -> DataFrame:
        """States that the bases hold: open ones of the newest, and ended ones that lasted beyond ``after``."""
        bases = self._bases()
        out = self._states_of(bases[0], schema, live=True)
        for base in bases:
            if base.version > after:  # earlier ones ended no later than their base
                out = out.unionByName(self._states_of(base, schema, live=False))
        return out

    def _states_since(self, base: Base | None, upto: int, schema: T.StructType, began: int | None = None) -> DataFrame:
        """States after ``base``: those open in it, ended where a later change ends them, and those that came later."""
        columns = schema.fieldNames()
        if base is None:
            return intervals(self.log(upto=upto, schema=schema), self.keys, columns)
        delta = self.log(upto=upto, since=base.version + 1, schema=schema)
        out = ended_by(self._states_of(base, schema, live=True), delta, self.keys, columns, base.buckets)
        if began is not None and began <= base.version:
            return out
        return out.unionByName(intervals(delta, self.keys, columns))

    def states(self, upto: int | None = None, schema: T.StructType | None = None, after: int = -1,
               began: int | None = None) -> DataFrame:
        """The table's states up to a version with ``_valid_from`` and ``_valid_to`` (NULL: holds in that version).
        States that ended at or before version ``after``, or began later than ``began``, may be left out."""
        v = self.version() if upto is None else int(upto)
        self._row(v)
        schema = schema or self.schema(v)
        bases = self._bases()
        key = (self.path, v, _HISTORY[self.path][0], tuple(bases), schema.json(), after, began, id(self.spark),
               self.spark.sparkContext.applicationId)
        if key not in _STATES:
            _keep(_STATES, key, self._states_plan(bases, v, schema, after, began))
        return _STATES[key]

    def _states_plan(self, bases: list[Base], v: int, schema: T.StructType, after: int, began: int | None) -> DataFrame:
        base = next(iter(bases), None)
        if base and v <= base.version:
            known = self._recorded(schema, after).where(F.col(VALID_FROM) <= v)
            return known.withColumn(VALID_TO, F.when(F.col(VALID_TO) <= v, F.col(VALID_TO)))
        out = self._states_since(base, v, schema, began)
        for older in bases:
            if older.version > after:
                out = out.unionByName(self._states_of(older, schema, live=False))
        return out

    def base(self, version: int | None = None, buckets: int | None = None) -> int:
        """Write a base at ``version``: the states open in it, bucketed by the key, and those that ended since the base
        before. Every version up to it is then read without an exchange and without the change files below it.

        ``buckets`` is the first base's; later ones keep its number, so that bases join bucket to bucket."""
        v = self.version() if version is None else int(version)
        last = self._newest_base()
        if last and last.version >= v:
            return last.version
        schema = self._wide_schema(v)
        n = last.buckets if last else buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        ident = uuid.uuid4().hex[:12]
        rows = self._states_since(last, v, schema).withColumn("_live", F.col(VALID_TO).isNull().cast("int"))
        name = f"verlog_base_{ident}"
        # One task a bucket, so that a bucket is one file; the table's name serves the writing only.
        (rows.repartition(n, *self.keys).write.partitionBy("_live").bucketBy(n, *self.keys).sortBy(*self.keys)
         .options(path=f"{self.bases_path}/version={v}.buckets={n}.{ident}", partitionOverwriteMode="static").saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")
        return v

    def _gone(self, lo: int, hi: int) -> list[int]:
        """Versions from ``lo`` to ``hi`` that wrote change rows whose files are no longer there."""
        there = set(list_children(self.spark, self.changes_path))
        return [int(r.version) for r in self._rows() if lo <= r.version <= hi and f"{COMMIT_VERSION}={r.version}" not in there
                and _changed(r)]

    def diff(self, old: int, new: int | None = None, compare: Sequence[str] | None = None,
             changed_only: bool = False) -> DataFrame:
        """Two versions side by side by key (``changes.diff_versions``), read from the states: rows that hold in both need
        no join."""
        new = self.version() if new is None else int(new)
        shared = [f for f in self.schema(new).fields if f.name in self.schema(old).fieldNames()]
        compare = list(compare) if compare is not None else [f.name for f in shared if f.name not in self.keys]
        schema = T.StructType(shared)
        lasting = None if changed_only else self._span(old, new, schema, lasting=True)
        return diff_states(self._span(old, new, schema), old, new, self.keys, compare, lasting)

    def diff_rows(self, old: int, new: int | None = None) -> DataFrame:
        """Whole rows of one version that the other lacks (``changes.diff_except``)."""
        new = self.version() if new is None else int(new)
        names = self.schema(old).fieldNames()
        shared = T.StructType([f for f in self.schema(new).fields if f.name in names])
        return except_states(self._span(old, new, shared), old, new, self.keys, shared.fieldNames())

    def _span(self, a: int, b: int, schema: T.StructType, lasting: bool = False) -> DataFrame:
        """States that hold in version ``a``, ``b`` or between; or at least those that hold in both."""
        self._row(a), self._row(b)
        lo, hi = sorted((int(a), int(b)))
        return self.states(hi, schema, after=lo, began=lo if lasting else None)

    def changed_between(self, a: int, b: int, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
        """The rows of version ``a`` that version ``b`` does not have as they are, and the other way round."""
        schema = schema or self._wide_schema(max(a, b))
        names = schema.fieldNames()
        if self._newest_base() is None:
            if self._gone(0, max(a, b)):
                return tuple(self._snapshot_rows(v, schema) for v in (a, b))
            # Without a base the keys that changed are found first, and only their rows dealt.
            return changed_between(self.log(upto=max(a, b), schema=schema), self.keys, a, b, names)
        states = self._span(a, b, schema)
        return only_in(states, a, b).select(*names), only_in(states, b, a).select(*names)

    def net_changes_to(self, version: int, schema: T.StructType | None = None) -> DataFrame:
        """Change rows that make the newest version equal to ``version``: what a restore writes. Only states that end or
        begin after ``version`` can differ from it."""
        now = self.version()
        schema = schema or self._wide_schema(now)
        if self._newest_base() is None:
            return net_changes(*self.changed_between(now, version, schema), self.keys)
        return net_states(self._span(now, version, schema), now, int(version), self.keys, schema.fieldNames())

    def _snapshot_rows(self, version: int, schema: T.StructType) -> DataFrame:
        rows = self.as_of(version)
        return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in schema.fields])

    def rows_where(self, predicate, version: int | None = None) -> DataFrame:
        """Rows of a version for which ``predicate`` is TRUE, reading only the keys
        that can qualify.

        The newest row of a key can only match if some change row of that key
        matches, so the predicate is first pushed into the log scan to find
        candidate keys; the log is semi-joined with them (unhinted: the planner
        broadcasts from measured bytes) before the as-of read, and the predicate
        is applied again to the newest rows.
        """
        v = self.version() if version is None else int(version)
        self._row(v)
        schema = self.schema(v)
        pred = F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))
        if self._newest_base() or self._base(v)[1] is not None or self._only_load(v) is not None:
            return self.as_of(v).where(pred)  # reaches the scan of the base or of the load by itself
        log = self.log(upto=v, schema=schema)
        live = F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE)
        candidates = log.where(live & pred).select(*self.keys).distinct()
        part = restrict_to(log, self.keys, candidates)
        return as_of(part, self.keys, None, schema.fieldNames()).where(pred)

    def rows_for_keys(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """Rows of a version whose key is in ``keys`` (a frame of the key
        columns), reading only those keys' change rows."""
        v = self.version() if version is None else int(version)
        self._row(v)
        schema = self.schema(v)
        keyed = F.lit(True)
        for k in self.keys:
            keyed = keyed & F.col(k).isNotNull()
        wanted = keys.where(keyed).select(*self.keys)
        if self._newest_base() or self._base(v)[1] is not None or self._only_load(v) is not None:
            return restrict_to(self.as_of(v), self.keys, wanted)
        part = restrict_to(self.log(upto=v, schema=schema), self.keys, wanted.distinct())
        return as_of(part, self.keys, None, schema.fieldNames())

    def as_of_many(self, versions: Sequence[int]) -> DataFrame:
        """Several versions in one scan (``_as_of`` tells which); columns of the newest."""
        top = max(int(v) for v in versions)
        for v in versions:
            self._row(int(v))
        schema = self.schema(top)
        if self._newest_base():
            return holding_in(self.states(top, schema, after=min(int(v) for v in versions)), versions) \
                .select(AS_OF, *schema.fieldNames())
        if self._gone(0, top):  # each version from its own snapshot
            parts = [self._snapshot_rows(v, schema).select(F.lit(v).cast("long").alias(AS_OF), "*")
                     for v in sorted({int(v) for v in versions})]
            return functools.reduce(DataFrame.unionByName, parts)
        return as_of_many(self.log(upto=top, schema=schema), self.keys, versions, schema.fieldNames())

    def as_of_timestamp(self, timestamp) -> DataFrame:
        """``t TIMESTAMP AS OF ts``."""
        return self.as_of(self.version_at(timestamp))

    def current(self) -> DataFrame:
        return self.as_of(None)

    def changes(self, start: int, end: int | None = None) -> DataFrame:
        """``table_changes(t, start[, end])``."""
        end = self.version() if end is None else int(end)
        if start < self.first_version():
            raise VersionError(f"change feed starts at version {self.first_version()}")
        schema = self.schema(end)
        return self.log(upto=end, since=start, schema=schema).select(
            *schema.fieldNames(), CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP)

    # ----------------------------------------------------------------- writes
    def _next_timestamp(self) -> _dt.datetime:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        now = now.replace(microsecond=now.microsecond // 1000 * 1000)
        try:
            last = _from_spark(self._rows()[-1].timestamp)
        except VersionError:
            return now
        return max(now, last + _dt.timedelta(milliseconds=1))

    def _write_commit(self, version: int, operation: str, params: Mapping, metrics: Mapping,
                      schema: T.StructType, props: Mapping, user: str | None,
                      timestamp: _dt.datetime | None = None) -> None:
        ts = timestamp or self._next_timestamp()
        user = user or self.spark.sparkContext.sparkUser()
        row = (version, ts.replace(tzinfo=_dt.timezone.utc), user, operation, {k: str(v) for k, v in params.items()},
               {k: str(v) for k, v in metrics.items()}, schema.json(), dict(props))
        # A committed version is never overwritten.
        (self.spark.createDataFrame([row], COMMITS_SCHEMA).drop("version").coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.commits_path}/version={version}"))
        self._history_cache = None
        # The writer knows the row it just committed: extend the process cache
        # instead of re-reading the history with a Spark job.
        cached = _HISTORY.get(self.path)
        if cached is not None and all(r.version < version for r in cached[1]):
            names = frozenset(x for x in list_stamped(self.spark, self.commits_path) if x[0].startswith("version="))
            added = {n for n, _ in names} - {n for n, _ in cached[0]}
            if added != {f"version={version}"}:
                _HISTORY.pop(self.path, None)   # someone else committed too: re-read
                return
            local_ts = ts.replace(tzinfo=_dt.timezone.utc).astimezone().replace(tzinfo=None)
            new = Row(version=version, timestamp=local_ts, schema_json=schema.json(), properties=dict(props),
                      operationMetrics={k: str(v) for k, v in metrics.items()})
            _HISTORY[self.path] = (names, [*cached[1], new])
        else:
            _HISTORY.pop(self.path, None)

    def commit(self, changes: DataFrame | None, operation: str, params: Mapping | None = None,
               schema: T.StructType | None = None, properties: Mapping[str, str] | None = None,
               user: str | None = None, enforce: bool = True) -> int:
        """Append ``changes`` as the next version; refuse it if a rule is broken.

        Jobs: write the change rows once, then one aggregate over what was
        written (metrics and every rule together), then the history row.
        """
        self.refresh()
        v = self.version() + 1
        schema = schema or self.schema()
        props = dict(self.properties())
        if properties:
            props.update(properties)
        ts = self._next_timestamp()
        metrics: dict[str, object] = {}
        part = f"{self.changes_path}/{COMMIT_VERSION}={v}"
        if changes is not None:
            cols = schema.fieldNames()
            keys = props[KEYS_PROP].split(",")
            rows, lossy = _conform_changes(changes, schema)
            id_col = props.get(IDENTITY_COL)
            stage = f"{self.path}/_staging/v{v}-{uuid.uuid4().hex}"
            if id_col:
                rows = self._fill_identity(rows, id_col, props, stage, check_explicit=enforce)
            new_rows = F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE)
            checks = {k[len(CHECK_PREFIX):]: e for k, e in props.items() if k.startswith(CHECK_PREFIX)}
            rule_preds = rules.table_rules(schema, checks) if enforce else {}
            aggs = [
                F.count_if(F.col(CHANGE_TYPE) == INSERT).alias("numInsertedRows"),
                F.count_if(F.col(CHANGE_TYPE) == DELETE).alias("numDeletedRows"),
                F.count_if(F.col(CHANGE_TYPE) == POSTIMAGE).alias("numUpdatedRows"),
                F.count_if(F.col(CHANGE_TYPE) == PREIMAGE).alias("_pre"),
                F.count_if(new_rows & F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))).alias("_no_key"),
            ]
            aggs += [F.count_if(new_rows & pred).alias(f"_rule{i}") for i, pred in enumerate(rule_preds.values())]
            aggs += [F.count_if(F.col(c)).alias(c) for c in lossy]
            if id_col:
                aggs.append(F.max(F.col(id_col)).alias("_max_id"))
            # Metrics and every rule are observed while the rows are written:
            # no second job over the new version.
            seen = Observation(f"commit_{v}_{uuid.uuid4().hex[:8]}")
            (rows.select(*cols, CHANGE_TYPE, *lossy).observe(seen, *aggs).drop(*lossy)
             .withColumn(COMMIT_TIMESTAMP, F.lit(ts.replace(tzinfo=_dt.timezone.utc)).cast("timestamp"))
             .write.mode("overwrite").parquet(part))
            if id_col:
                delete_path(self.spark, stage)
            stats = dict(seen.get)
            for k in ("numInsertedRows", "numDeletedRows", "numUpdatedRows", "_pre", "_no_key"):
                stats[k] = int(stats.get(k) or 0)
            broken = {name: stats[f"_rule{i}"] for i, name in enumerate(rule_preds) if stats[f"_rule{i}"]}
            if broken:
                delete_path(self.spark, part)
                raise rules.RuleViolation(f"{operation} refused, rows violating rules: {broken}")
            lost = {lossy[c]: stats[c] for c in lossy if stats.get(c)}
            if lost:
                delete_path(self.spark, part)
                raise rules.RuleViolation(f"{operation} refused, values that their columns' types do not hold: {lost}")
            if stats["_pre"] != stats["numUpdatedRows"]:
                delete_path(self.spark, part)
                raise VersionError("preimage and postimage counts differ")
            if stats["_no_key"]:
                delete_path(self.spark, part)
                raise rules.RuleViolation(f"{operation} refused, {stats['_no_key']} rows with a NULL key")
            taken = self._taken_keys(part, schema, keys, stats["numInsertedRows"], operation in KEY_CHECKED)
            if taken:
                delete_path(self.spark, part)
                raise rules.RuleViolation(f"{operation} refused, key {taken} would be held twice")
            metrics = {
                "numOutputRows": stats["numInsertedRows"] + stats["numUpdatedRows"],
                "numInsertedRows": stats["numInsertedRows"],
                "numUpdatedRows": stats["numUpdatedRows"],
                "numDeletedRows": stats["numDeletedRows"],
            }
            if id_col and stats.get("_max_id") is not None:
                props[IDENTITY_HWM] = str(max(int(props.get(IDENTITY_HWM, "0")), int(stats["_max_id"])))
        elif path_exists(self.spark, part):
            delete_path(self.spark, part)  # orphan files of an earlier failed try
        self._write_commit(v, operation, params or {}, metrics, schema, props, user, ts)
        for interval, write in ((SNAPSHOT_INTERVAL, self.snapshot), (BASE_INTERVAL, self.base)):
            every = int(props.get(interval, "0") or 0)
            if every > 0 and v % every == 0:
                write(v)
        return v

    def _taken_keys(self, part: str, schema: T.StructType, keys: list[str], inserted: int, against_table: bool):
        """A key that the written change rows give to two rows, or to a row beside a live one; None if there is none."""
        full = T.StructType([*schema.fields, T.StructField(CHANGE_TYPE, T.StringType())])
        written = self.spark.read.schema(full).parquet(part)
        twice = (written.where(F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE)).groupBy(*keys)
                 .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
        found = _any_key(twice, keys)
        if found is None and against_table and inserted and self.version() > 0:
            added = written.where(F.col(CHANGE_TYPE) == INSERT).select(*keys)
            gone = written.where(F.col(CHANGE_TYPE) == DELETE).select(*keys)
            found = _any_key(self.rows_for_keys(added.join(gone, keys, "left_anti")), keys)
        return found

    def _fill_identity(self, rows: DataFrame, id_col: str, props: Mapping[str, str], stage: str,
                       check_explicit: bool = True) -> DataFrame:
        """Number inserted rows that carry no id, after the high-water mark.

        The rows are written once to ``stage``, those to be numbered apart and in their
        incoming order; their places in the files are their numbers.
        """
        mode = props.get(IDENTITY_MODE, "ALWAYS")
        inserts = F.col(CHANGE_TYPE) == F.lit(INSERT)
        # Explicit ids on inserts are counted while staging (no extra pass).
        seen = Observation(f"ids_{uuid.uuid4().hex[:12]}")
        (rows.observe(seen, F.count_if(inserts & F.col(id_col).isNotNull()).alias("explicit"))
         .withColumns({"_todo": (inserts & F.col(id_col).isNull()).cast("int"), "_seq": F.monotonically_increasing_id()})
         .sortWithinPartitions("_todo", "_seq").drop("_seq").write.partitionBy("_todo").parquet(stage))
        if mode == "ALWAYS" and check_explicit and (seen.get.get("explicit") or 0):   # restore re-inserts ids
            delete_path(self.spark, stage)
            raise rules.RuleViolation(f"{id_col} is GENERATED ALWAYS; explicit values are refused")
        parts = [self.spark.read.schema(rows.schema).parquet(f"{stage}/_todo={k}") if path_exists(self.spark, f"{stage}/_todo={k}")
                 else self.spark.createDataFrame([], rows.schema) for k in (0, 1)]
        if path_exists(self.spark, f"{stage}/_todo=1"):
            parts[1] = number_files(parts[1], id_col, int(props.get(IDENTITY_HWM, "0")) + 1).select(*rows.columns)
        return parts[0].unionByName(parts[1])

    # ------------------------------------------------------------- statements
    def insert(self, rows: DataFrame, user: str | None = None) -> int:
        return self.commit(dml.insert_changes(rows), "WRITE", {"mode": "Append"}, user=user)

    def update(self, assignments: Mapping[str, object], where=None, user: str | None = None) -> int:
        """Rows whose key changes are deleted and inserted under the new key; a key that is taken is refused."""
        self.refresh()
        current = self.current() if where is None else self.rows_where(where)
        changes = dml.update_changes(current, assignments, where, self.keys)
        return self.commit(changes, "UPDATE", {"predicate": str(where)}, user=user)

    def delete(self, where, user: str | None = None) -> int:
        self.refresh()
        current = self.current() if where is None else self.rows_where(where)
        return self.commit(dml.delete_changes(current, where), "DELETE", {"predicate": str(where)}, user=user)

    def merge(self, source: DataFrame, on: str | Sequence[str], matched_update=None, not_matched_insert=None,
              user: str | None = None) -> int:
        self.refresh()
        on_cols = [on] if isinstance(on, str) else list(on)
        # On the table key, only target rows whose key is in the source can match.
        target = self.rows_for_keys(source) if sorted(on_cols) == sorted(self.keys) else self.current()
        changes = dml.merge_changes(target, source, on, matched_update, not_matched_insert)
        try:
            return self.commit(changes, "MERGE", {"on": str(on)}, user=user)
        except PySparkException as failed:
            if dml.TWICE not in str(failed):
                raise
            raise dml.DuplicateSourceKeys(f"{dml.TWICE} on {on_cols}") from None

    def restore(self, version: int, user: str | None = None) -> int:
        """``RESTORE TABLE t TO VERSION AS OF n``: a new version equal to version n.

        Costs one full join, by key, of the rows that differ (not metadata-only).
        """
        self.refresh()
        target_schema = self.schema(version)
        self._row(version)
        now = self.version()
        union = T.StructType([*self.schema(now).fields,
                              *[f for f in target_schema.fields if f.name not in self.schema(now).fieldNames()]])
        changes = self.net_changes_to(version, union)
        cols = [*target_schema.fieldNames()]
        # Columns the old version did not have are dropped again.
        return self.commit(changes.select(*cols, CHANGE_TYPE), "RESTORE", {"version": version},
                           schema=target_schema, user=user, enforce=False)

    def replace_with(self, rows: DataFrame, user: str | None = None,
                     operation: str = "CREATE OR REPLACE TABLE AS SELECT", params: Mapping | None = None) -> int:
        """``CREATE OR REPLACE TABLE t AS SELECT``: a new version holding exactly
        ``rows`` (and their schema); history is kept, so the old contents stay
        readable with ``as_of``."""
        self.refresh()
        schema = T.StructType([T.StructField(f.name, f.dataType, f.nullable or f.name not in self.keys)
                               for f in rows.schema.fields])
        missing = [k for k in self.keys if k not in schema.fieldNames()]
        if missing:
            raise VersionError(f"replacement lacks key columns {missing}")
        types = {f.name: f.dataType for f in schema.fields}
        retyped = [f.name for f in self._wide_schema(self.version()).fields if types.get(f.name, f.dataType) != f.dataType]
        if retyped:
            raise VersionError(f"replacement changes the type of {retyped}: old versions could not be read with it")
        changes = net_changes(self.current(), rows, self.keys)
        return self.commit(changes.select(*schema.fieldNames(), CHANGE_TYPE), operation, params or {}, schema=schema, user=user)

    def add_columns(self, fields: Sequence[T.StructField], user: str | None = None) -> int:
        """``ALTER TABLE ADD COLUMN``: old rows read NULL."""
        schema = self.schema()
        names = set(schema.fieldNames())
        for f in fields:
            if f.name in names:
                raise VersionError(f"column {f.name} exists")
        new = T.StructType([*schema.fields, *[T.StructField(f.name, f.dataType, True, f.metadata) for f in fields]])
        return self.commit(None, "ADD COLUMNS", {"columns": ",".join(f.name for f in fields)}, schema=new, user=user)

    def add_check(self, name: str, expr: str, user: str | None = None) -> int:
        """``ADD CONSTRAINT n CHECK (expr)``: existing rows are validated first."""
        bad = self.current().where(rules.check_violation(expr)).limit(1).count()
        if bad:
            raise rules.RuleViolation(f"existing rows violate CHECK {name}: {expr}")
        return self.commit(None, "ADD CONSTRAINT", {"name": name, "expr": expr},
                           properties={CHECK_PREFIX + name: expr}, user=user)

    def set_properties(self, properties: Mapping[str, str], user: str | None = None) -> int:
        return self.commit(None, "SET TBLPROPERTIES", dict(properties), properties=properties, user=user)

    def snapshot(self, version: int | None = None, cluster_by: str | None = None, files: int | None = None) -> int:
        """Write ``as_of(version)`` as a base snapshot; later reads start from it.

        ``OPTIMIZE`` / ``ZORDER BY (c)`` is a snapshot with ``files`` and
        ``cluster_by``: rows are range-partitioned on ``c`` and sorted within
        each file, so filters on ``c`` skip row groups (the candidate scan of
        ``rows_where`` profits directly). Results of every read are unchanged.
        """
        v = self.version() if version is None else int(version)
        rows = self.as_of(v)
        if cluster_by:
            # The key splits a value that many rows share.
            order = [F.col(c) for c in dict.fromkeys([cluster_by, *self.keys])]
            rows = rows.repartitionByRange(int(files), *order) if files else rows.repartitionByRange(*order)
            rows = rows.sortWithinPartitions(cluster_by)
        elif files:
            rows = rows.repartition(int(files))
        # A fresh folder each time: the rows may be read from the newest snapshot of this very version.
        taken = sum(b == v for b, _ in self._snapshots())
        rows.write.parquet(f"{self.snapshots_path}/version={v}" + (f".{taken}" if taken else ""))
        return v

    def detail(self) -> DataFrame:
        """``DESCRIBE DETAIL``: one row with location, version, file count and
        bytes of the files the latest version reads (one distributed listing),
        keys and properties."""
        from verlog.operators import layout

        v = self.version()
        roots = [p for p in (self.changes_path, self.snapshots_path, self.bases_path) if path_exists(self.spark, p)]
        files = layout.file_inventory(self.spark, roots) if roots else \
            self.spark.createDataFrame([], "path string, length long, modificationTime timestamp")
        ver = F.regexp_extract("path", r"/_changes/_commit_version=(\d+)/", 1)
        snap = F.regexp_extract("path", r"/_snapshots/version=(\d+)(?:\.\d+)?/", 1)
        b, _ = self._base(v)
        newest = self._newest_base()
        if newest and newest.version >= b:
            start, from_start = newest.version, F.col("path").contains(f"/{newest.path.rsplit('/', 1)[1]}/_live=1/")
        else:
            start, from_start = b, (snap != "") & (snap.cast("long") == b)
        live = files.where(((ver != "") & (ver.cast("long") <= v) & (ver.cast("long") > start)) | from_start)
        props = self.properties()
        return live.agg(F.count(F.lit(1)).alias("numFiles"), F.coalesce(F.sum("length"), F.lit(0)).alias("sizeInBytes")) \
            .select(F.lit("parquet change log").alias("format"), F.lit(self.path).alias("location"),
                    F.lit(v).cast("long").alias("version"), "numFiles", "sizeInBytes",
                    F.lit(",".join(self.keys)).alias("keys"),
                    F.create_map(*[x for k, val in sorted(props.items()) for x in (F.lit(k), F.lit(val))])
                    .alias("properties"))

    def purge_plan(self, now: _dt.datetime | None = None, log_days: int | None = None,
                   file_days: int | None = None) -> DataFrame:
        """``VACUUM t DRY RUN``: data files no reachable version needs.

        Reachable versions are those committed inside the retention window (the
        smaller of log and file retention) plus the latest. With ``r0`` the
        oldest reachable version, no reachable read needs change partitions below
        ``r0`` that the newest base covers, nor open states of older bases;
        likewise what the newest snapshot ``b`` at or before ``r0`` covers, and
        snapshots older than ``b``. The feed of reachable versions keeps its files.
        Uncommitted partitions
        (a failed commit's orphans) are never needed. Only files older than the
        file retention are listed. Nothing is deleted.
        """
        from verlog.operators import layout

        props = self.properties()
        log_days = layout.retention_days(props.get(LOG_RETENTION), layout.LOG_RETENTION_DAYS) \
            if log_days is None else int(log_days)
        file_days = layout.retention_days(props.get(FILE_RETENTION), layout.FILE_RETENTION_DAYS) \
            if file_days is None else int(file_days)
        now = _naive(now or _dt.datetime.now(_dt.timezone.utc))
        window = _dt.timedelta(days=min(log_days, file_days))
        rows = self._rows()
        latest = int(rows[-1].version)
        r0 = min([int(r.version) for r in rows if _from_spark(r.timestamp) >= now - window] + [latest])
        snaps = sorted(b for b, n in self._snapshots() if path_exists(self.spark, f"{self.snapshots_path}/{n}/_SUCCESS"))
        b = max([x for x in snaps if x <= r0], default=-1)
        base = self._newest_base()
        upto = base.version if base else -1
        roots = [p for p in (self.changes_path, self.snapshots_path, self.bases_path, f"{self.path}/_staging")
                 if path_exists(self.spark, p)]
        if not roots:
            return self.spark.createDataFrame([], "path string, length long, modificationTime timestamp, reason string")
        inv = layout.file_inventory(self.spark, roots)
        ver = F.regexp_extract("path", r"/_changes/_commit_version=(\d+)/", 1)
        snap = F.regexp_extract("path", r"/_snapshots/version=(\d+)(?:\.\d+)?/", 1)
        reason = (F.when((ver != "") & (ver.cast("long") > F.lit(latest)), F.lit("uncommitted version"))
                  .when((ver != "") & (ver.cast("long") <= F.lit(upto)) & (ver.cast("long") < F.lit(r0)),
                        F.lit(f"covered by base {upto}"))
                  .when((ver != "") & (ver.cast("long") <= F.lit(b)) & (ver.cast("long") < F.lit(r0)),
                        F.lit(f"covered by snapshot {b}"))
                  .when(F.col("path").contains("/_bases/") & F.col("path").contains("/_live=1/")
                        & ~F.col("path").contains(f"/{base.path.rsplit('/', 1)[1]}/" if base else "/-/"),
                        F.lit(f"superseded by base {upto}"))
                  .when((snap != "") & (snap.cast("long") < F.lit(b)), F.lit(f"superseded by snapshot {b}"))
                  .when(F.col("path").contains("/_staging/"), F.lit("staging leftover")))
        cutoff = F.lit(now.replace(tzinfo=_dt.timezone.utc)).cast("timestamp") - F.expr(f"INTERVAL {file_days} DAYS")
        return (inv.select("path", "length", "modificationTime", reason.alias("reason"))
                .where(F.col("reason").isNotNull() & (F.col("modificationTime") < cutoff)))

    def optimize(self, zorder_by: str | None = None, files: int | None = None) -> int:
        """``OPTIMIZE t [ZORDER BY (c)]``: a compacted, optionally clustered base
        snapshot of the latest version (no new version; contents unchanged)."""
        return self.snapshot(None, cluster_by=zorder_by, files=files)

    def clone(self, path: str, version: int | None = None, shallow: bool = False,
              user: str | None = None, replace: bool = False) -> "VersionedTable":
        """``DEEP CLONE`` (rows copied, own history from version 0) or ``SHALLOW CLONE``
        (reads the source's files pinned at ``version``).

        ``replace`` (``CREATE OR REPLACE ... CLONE``, deep): a table that is there gets one more version with exactly
        these rows, written as the changes against what it holds; its earlier versions stay."""
        v = self.version() if version is None else int(version)
        schema = self.schema(v)
        props = {k: x for k, x in self.properties(v).items() if not k.startswith("verlog.clone.")}
        t = VersionedTable(self.spark, path)
        if t.exists():
            if not replace:
                raise VersionError(f"table already exists at {path}")
            if shallow:
                raise VersionError("a table with rows of its own cannot become a shallow copy")
            t.replace_with(self.as_of(v), user=user, operation="CREATE OR REPLACE TABLE CLONE",
                           params={"source": self.path, "sourceVersion": v})
            return t
        params = {"source": self.path, "sourceVersion": v, "shallow": shallow}
        if shallow:
            props[CLONE_SOURCE] = self.path
            props[CLONE_VERSION] = str(v)
            t._write_commit(0, "CLONE", params, {}, schema, props, user)
            return t
        part = f"{t.changes_path}/{COMMIT_VERSION}=0"
        ts = _naive(_dt.datetime.now(_dt.timezone.utc))
        seen = Observation(f"clone_{uuid.uuid4().hex[:12]}")
        (self.as_of(v).observe(seen, F.count(F.lit(1)).alias("n")).withColumn(CHANGE_TYPE, F.lit(INSERT))
         .withColumn(COMMIT_TIMESTAMP, F.lit(ts.replace(tzinfo=_dt.timezone.utc)).cast("timestamp"))
         .write.mode("overwrite").parquet(part))
        n = int(seen.get.get("n") or 0)
        t._write_commit(0, "CLONE", params, {"numOutputRows": n, "numInsertedRows": n}, schema, props, user, ts)
        return t


def _changed(row: Row) -> bool:
    """Whether the version of a history row wrote change rows."""
    metrics = row.operationMetrics or {}
    return any(int(metrics.get(m) or 0) for m in ("numInsertedRows", "numUpdatedRows", "numDeletedRows"))


def _any_key(rows: DataFrame, keys: Sequence[str]) -> tuple | None:
    """A key of ``rows``, or None: one job, where ``take`` on rows that are none runs several, one after another."""
    found = rows.agg(F.first(F.struct(*keys)).alias("key")).first()["key"]
    return None if found is None else tuple(found)


def _conform_changes(changes: DataFrame, schema: T.StructType) -> tuple[DataFrame, dict[str, str]]:
    """The change rows in the table's types, with a flag column for each column whose values those types may not hold."""
    row_part = changes.drop(CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP)
    problems = [p for p in rules.schema_mismatch(row_part.schema, schema) if p.startswith("unexpected")]
    if problems:
        raise rules.RuleViolation("schema mismatch: " + "; ".join(problems))
    retyped = [f for f in schema.fields if f.name in changes.columns and changes.schema[f.name].dataType != f.dataType]
    flags = {f"_lossy{i}": f.name for i, f in enumerate(retyped)}
    return changes.select(
        *[(rules.held_as(F.col(f.name), changes.schema[f.name].dataType, f.dataType) if f in retyped
           else F.col(f.name) if f.name in changes.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields],
        CHANGE_TYPE, *[rules.not_held(F.col(f.name), changes.schema[f.name].dataType, f.dataType).alias(flag)
                       for flag, f in zip(flags, retyped)]), flags


def _from_spark(ts: _dt.datetime) -> _dt.datetime:
    """A collected TIMESTAMP (naive, process-local time) as naive UTC."""
    if ts.tzinfo is None:
        ts = ts.astimezone()
    return ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)


def _naive(ts) -> _dt.datetime:
    """A user-given time as naive UTC (naive input is taken as UTC)."""
    if isinstance(ts, str):
        ts = _dt.datetime.fromisoformat(ts)
    if isinstance(ts, _dt.date) and not isinstance(ts, _dt.datetime):
        ts = _dt.datetime(ts.year, ts.month, ts.day)
    if ts.tzinfo is not None:
        ts = ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return ts
