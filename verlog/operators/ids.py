"""Distributed generation of identity values (``GENERATED AS IDENTITY``).

Rows are written once, in the order their ids shall follow. A row's id is then the
start, plus the rows of the files before its own, plus its place in its file
(``_metadata.row_index``): one count for each file, one row for each file in the
running sum, and no second sort, checkpoint or window over the rows. What is
numbered is what was written, so a lost executor sees the same rows again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verlog.session import work_root

_FILE, _ROW = "_ids_file", "_ids_row"


def number_files(written: DataFrame, id_col: str, start: int = 1) -> DataFrame:
    """``written`` (a plain read of Parquet files of one write) with ``id_col`` = start, start + 1, ... in the order
    of its files and of the rows in them."""
    placed = written.withColumns({_FILE: F.col("_metadata.file_path"), _ROW: F.col("_metadata.row_index")})
    counts = placed.groupBy(_FILE).agg(F.count(F.lit(1)).alias("_n"))
    # Tasks number their files; past 99,999 the names are longer.
    task = F.regexp_extract(_FILE, r"/part-(\d+)[^/]*$", 1).cast("long")
    before = Window.orderBy(task, _FILE).rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    offsets = counts.select(_FILE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    value = (F.lit(int(start)) + F.col("_off") + F.col(_ROW)).cast("long")
    return placed.join(offsets, _FILE).withColumn(id_col, value).drop(_FILE, _ROW, "_off")


def assign_ids(df: DataFrame, id_col: str, start: int = 1, order_by: Sequence | None = None,
               keep: Sequence[str] | None = None) -> DataFrame:
    """Fill ``id_col`` with ``start, start+1, ...`` in the order of ``order_by``, or as the rows come. ``keep`` names the
    columns to write beside it (default: all); the order may need more of them."""
    rows = df.drop(id_col)
    if order_by:
        rows = rows.orderBy(*order_by)
    if keep is not None:
        rows = rows.select(*keep)
        df = df.select(*keep)
    path = f"{work_root(df.sparkSession)}/verlog-ids/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    cols = df.columns if id_col in df.columns else [*df.columns, id_col]
    return number_files(df.sparkSession.read.schema(rows.schema).parquet(path), id_col, start).select(*cols)
