"""Conversations as ordered streams of turns, for the operators that read them turn by turn."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: An output batch closes at so many rows or code points of text.
ROWS, CHARS = 4096, 1 << 22


def in_order(rows: DataFrame, conversation: str, by: list[Column]) -> DataFrame:
    """A conversation's rows side by side in one partition, ordered by ``by``."""
    return rows.repartition(F.col(conversation)).sortWithinPartitions(F.col(conversation), *by)


def streamed(rows: DataFrame, step: Callable[[Iterator[tuple]], Iterable[tuple]], schema: StructType,
             text: int | None = None) -> DataFrame:
    """``step`` over each partition's rows as tuples, in order; nothing of a partition is held but what
    ``step`` holds. ``text``: place of the output column whose length bounds a batch."""
    arrow = to_arrow_schema(schema)

    def run(batches):
        held, chars = [], 0
        given = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns], strict=True))
        for row in step(given):
            held.append(row)
            chars += len(row[text] or "") if text is not None else 0
            if len(held) >= ROWS or chars >= CHARS:
                yield _batch(held, arrow)
                held, chars = [], 0
        if held:
            yield _batch(held, arrow)

    return rows.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
