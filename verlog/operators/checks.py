"""Checks: preflight row counts and a scoreboard that evaluates every check.

A check is a DataFrame with one row per finding and a boolean ``passed``.
The scoreboard unions all checks into one job and marks a check FAIL when any
of its rows failed -- every check is evaluated; none can hide another.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ChecksFailed(AssertionError):
    pass


def preflight_counts(actual: Mapping[str, DataFrame], expected: Mapping[str, DataFrame | int]) -> DataFrame:
    """One row per input: expected rows, actual rows, PASS/FAIL. All counts are
    aggregates in a single union (one job)."""
    parts = []
    for name, df in actual.items():
        spark = df.sparkSession
        parts.append(df.agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(name).alias("table_name"), F.lit("actual").alias("kind"), "n"))
        exp = expected[name]
        if isinstance(exp, DataFrame):
            parts.append(exp.agg(F.count(F.lit(1)).alias("n"))
                         .select(F.lit(name).alias("table_name"), F.lit("expected").alias("kind"), "n"))
        else:
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit("expected").alias("kind"),
                                               F.lit(int(exp)).cast("long").alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.groupBy("table_name").agg(
        F.max(F.when(F.col("kind") == "expected", F.col("n"))).alias("expected_rows"),
        F.max(F.when(F.col("kind") == "actual", F.col("n"))).alias("actual_rows"))
    return out.withColumn("status", F.when(F.col("expected_rows") == F.col("actual_rows"), F.lit("PASS"))
                          .otherwise(F.lit("FAIL")))


def equal_rows(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """A check: two relations hold the same bag of rows (``exceptAll`` both ways)."""
    cols = left.columns
    diff = left.exceptAll(right.select(*cols)).unionAll(right.select(*cols).exceptAll(left))
    return diff.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("check_name"), (F.col("n") == 0).alias("passed"),
        F.concat(F.col("n").cast("string"), F.lit(" differing rows")).alias("detail"))


def scoreboard(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: PASS only if all of its rows passed."""
    parts = [df.select(F.lit(name).alias("check_name"), F.col("passed"), F.col("detail").cast("string"))
             for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.groupBy("check_name")
            .agg(F.when(F.bool_and("passed"), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
                 F.min("detail").alias("detail")))


def raise_on_failure(board: DataFrame) -> None:
    failed = [r.check_name for r in board.where(F.col("status") != "PASS").select("check_name").collect()]
    if failed:
        raise ChecksFailed(f"checks failed: {failed}")
