"""Write rules: NOT NULL, CHECK and schema enforcement.

Each rule is a boolean Column that is TRUE for a *violating* row, so all rules
of a table are counted in one aggregate job over the rows being written.
A CHECK whose expression is NULL passes (ANSI ``CHECK`` semantics).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DataType, StringType, StructType


class RuleViolation(ValueError):
    """A write was refused; nothing was committed."""


def not_null_violation(cols: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull()
    return out


def check_violation(expr: str | Column) -> Column:
    e = F.expr(expr) if isinstance(expr, str) else expr
    return ~F.coalesce(e, F.lit(True))


def table_rules(schema: StructType, checks: Mapping[str, str]) -> dict[str, Column]:
    """Rule name -> violating-row predicate for a table's schema and CHECKs."""
    rules: dict[str, Column] = {}
    required = [f.name for f in schema.fields if not f.nullable]
    if required:
        rules["not_null"] = not_null_violation(required)
    for name, expr in checks.items():
        rules[f"check:{name}"] = check_violation(expr)
    return rules


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per (rule, violating row): the rows a write would be refused for."""
    parts = [df.where(pred).select(F.lit(name).alias("rule"), *df.columns) for name, pred in rules.items()]
    if not parts:
        return df.limit(0).select(F.lit("").alias("rule"), *df.columns)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_mismatch(incoming: StructType, table: StructType) -> list[str]:
    """Problems that make a write refused: unknown columns, type changes.

    Missing nullable columns are allowed (they read NULL).
    """
    have = {f.name: f for f in table.fields}
    problems = []
    for f in incoming.fields:
        if f.name not in have:
            problems.append(f"unexpected column {f.name} {f.dataType.simpleString()}")
        elif f.dataType != have[f.name].dataType:
            problems.append(
                f"column {f.name} is {f.dataType.simpleString()}, table has {have[f.name].dataType.simpleString()}")
    names = {f.name for f in incoming.fields}
    for f in table.fields:
        if f.name not in names and not f.nullable:
            problems.append(f"missing required column {f.name}")
    return problems


def held_as(value: Column, given: DataType, kept: DataType) -> Column:
    """``value`` in the type of its column, NULL where that type cannot hold it at all."""
    return value.try_cast(kept) if _castable(given) and _castable(kept) else value.cast(kept)


def not_held(value: Column, given: DataType, kept: DataType) -> Column:
    """TRUE where ``value`` would not be stored as it is: it does not parse, is out of range, or comes back as another
    value (a fraction in an integer column, a time of day in a date column). Text is judged by whether it parses."""
    if not (_castable(given) and _castable(kept)):
        return F.lit(False)
    stored = value.try_cast(kept)
    lost = stored.isNull()
    if not isinstance(given, StringType) and not isinstance(kept, StringType):
        lost = lost | ~stored.try_cast(given).eqNullSafe(value)
    return value.isNotNull() & lost


def _castable(kind: DataType) -> bool:
    return isinstance(kind, AtomicType)


def refused_rows(df: DataFrame, table: StructType) -> DataFrame:
    """The rows that a write would be refused for by their types: one row for each such value, with its column."""
    out = df.limit(0).select(F.lit("").alias("refused_column"), *df.columns)
    for f in table.fields:
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            bad = df.where(not_held(F.col(f.name), df.schema[f.name].dataType, f.dataType))
            out = out.unionByName(bad.select(F.lit(f.name).alias("refused_column"), *df.columns))
    return out


def conformance(df: DataFrame, table: StructType) -> DataFrame:
    """Schema enforcement on a batch, row by row: one row per problem with the
    number of rows it affects, all counted in one aggregate.

    * an unexpected column: rows where it holds a value (the write would drop it)
    * a type mismatch: rows whose value does not survive the cast to the table type
    * a missing required column: every row
    """
    have = {f.name: f for f in table.fields}
    checks: list[tuple[str, Column]] = []
    for f in df.schema.fields:
        if f.name not in have:
            checks.append((f"unexpected column {f.name}", F.col(f.name).isNotNull()))
        elif f.dataType != have[f.name].dataType:
            target = have[f.name].dataType
            checks.append((f"column {f.name} is {f.dataType.simpleString()}, table has {target.simpleString()}",
                           not_held(F.col(f.name), f.dataType, target)))
    names = set(df.columns)
    for f in table.fields:
        if f.name not in names and not f.nullable:
            checks.append((f"missing required column {f.name}", F.lit(True)))
    if not checks:
        return df.sparkSession.createDataFrame([], "problem string, rows_affected long")
    counts = df.agg(*[F.count_if(c).alias(f"_p{i}") for i, (_, c) in enumerate(checks)])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("problem"), F.col(f"_p{i}").alias("rows_affected"))
        for i, (name, _) in enumerate(checks)])).alias("p")).select("p.problem", "p.rows_affected")
