"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verlog.session import work_root
from verlog.sources.testdata import table  # noqa: F401  (re-exported for the query modules)

#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def put_away(names: list[str]) -> tuple[list[Column], list[Column]]:
    """Columns ``names`` under names that no operator uses, and the way back."""
    return ([q(c).alias(f"_in_{i}") for i, c in enumerate(names)],
            [F.col(f"_in_{i}").alias(c) for i, c in enumerate(names)])


def others(df: DataFrame, new: list[str], drop: tuple[str, ...] = ()) -> list[str]:
    """Columns of ``df`` carried to a result that adds ``new``: an input column
    that clashes with a new one gives way to it."""
    gone = {c.lower() for c in [*new, *drop]}
    return [c for c in df.columns if c.lower() not in gone]


def q(name: str) -> Column:
    """A column by its literal name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to a fresh folder of the shared work folder and read it
    back: cuts lineage in a way that a lost executor cannot undo."""
    spark = df.sparkSession
    path = f"{work_root(spark)}/verlog-llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hold(df: DataFrame) -> DataFrame:
    """Whole rows made once, by a checkpoint in the shared folder. Where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, Spark deletes it
    as soon as nothing refers to it; facts that several jobs read go to ``stage``."""
    work_root(df.sparkSession)
    return df.checkpoint(eager=True)


#: Texts go to Python workers in batches of so many bytes at most (a longer text goes alone).
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds what a worker and its task hold of whole texts at once, unless the session has a bound of its own:
    Spark's own 64 MB are held by the task, by the worker as Arrow data, and again as Python strings."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, f"{BATCH_BYTES}b")


_caches: dict[str, Callable[[], None]] = {}


def caches_of(owner: str, let_go: Callable[[], None]) -> None:
    """In a worker: ``owner`` is about to fill its caches, so those of other operators are let go. Spark keeps workers
    for later stages, and a pipeline's operators would hold all their caches side by side."""
    for other in [o for o in _caches if o != owner]:
        _caches.pop(other)()
    _caches[owner] = let_go


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces_for(rows: int, per_piece: int, spark: SparkSession, spread: int = 4) -> int:
    """How many pieces ``rows`` are dealt to: bounded rows a piece, and several
    pieces for each shuffle partition so that they spread evenly."""
    return max(math.ceil(rows / per_piece), spread * partitions(spark), 1)
