"""Exact top-k inner-product search by block-at-a-time pruning.

Vectors are rounded to integers and laid out in document-range blocks: rows are
ordered by the signs of their leading components (so that a block's rows point
the same way), then id; ranges of that order hold consecutive blocks of
``BLOCK`` rows. A block keeps its forward index (the integer matrix) and each
component's maximum and minimum. For a query the sum over its components of the
larger of weight * maximum and weight * minimum bounds every score in the
block. Blocks are visited by falling bound; a block is scored only while its
bound reaches the query's k-th score so far (equal bounds are scored, as ties
go to smaller ids).

A query is a row itself, and the other rows of its own block point its way: when
blocks are packed, their queries' k best in the same block give each query a k-th
score to start from. Queries are a stated set, packed in chunks. First the chunks meet
each range's component maxima and minima only (a 128th of its rows), which
tells the queries that some block of the range can still serve; a range's blocks are
sent to a chunk, and a query to a range, only where that is so. There the blocks are
visited, each pair returns at most k rows a query, and one window per query picks the
best of the ranges. Where no bound falls below any k-th score, every query meets every
range, in blocks.

Nulls and odd rows: vectors that are null or hold null or non-finite
components, and rows with a null id, take no part; shorter vectors count as
padded with zeros; repeated rows and equal ids are separate candidates (a query
leaves out only its own row); fewer than k candidates give fewer rows; an empty
table gives an empty result; extra columns are ignored. Scores are exact while
they fit 63 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verlog.llm.common import partitions, q, stage

BLOCK = 256
#: Rows of a range and queries of a group: what meets in one task call.
RANGE, CHUNK = 16_384, 4_096
_SIGNS = 16


def integer_vectors(table: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """(id, v array<long>, at) of the vectors that take part: v = floor(scale * component)."""
    return (table.select(q(id).cast("long").alias("id"), F.transform(q(vector), lambda c: c.cast("double")).alias("x"),
                         F.monotonically_increasing_id().alias("at"))
            .where(F.col("id").isNotNull() & F.col("x").isNotNull())
            .where(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
            .select("id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"), "at"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _packed(size: int, width: int, label: str, k: int = 0):
    """Packs consecutive rows of a partition into (label, ids, ats, matrix) of ``size`` rows; with ``k``, also the
    component maxima and minima, and the rows that are queries with the k-th score that their own block gives them."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, number = None, 0
        for part in parts:
            part = part if rest is None else pd.concat([rest, part], ignore_index=True)
            while len(part) >= size:
                yield one(part.iloc[:size], number)
                number, part = number + 1, part.iloc[size:]
            rest = part
        if rest is not None and len(rest):
            yield one(rest, number)

    def one(rows: pd.DataFrame, number: int) -> pd.DataFrame:
        group = rows[label].iloc[0]
        m = _matrix(list(rows["v"]), width)
        ats = rows["at"].to_numpy(np.int64)
        out = {label: [group], "number": [number], "ids": [rows["id"].to_numpy(np.int64).tobytes()], "ats": [ats.tobytes()],
               "m": [m.tobytes()]}
        if k:
            asked = np.flatnonzero(rows["asked"].to_numpy(bool))
            score = _product(m[asked], m)
            score[np.arange(len(asked)), asked] = LEAST  # not itself
            start = np.partition(score, len(m) - k, axis=1)[:, len(m) - k] if len(m) > k else np.full(len(asked), LEAST)
            out |= {"high": [m.max(axis=0).tobytes()], "low": [m.min(axis=0).tobytes()], "q_ats": [ats[asked].tobytes()],
                    "starts": [start.tobytes()]}
        return pd.DataFrame(out)

    return run


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T: in doubles where every partial sum fits 53 bits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _best(query: np.ndarray, score: np.ndarray, id: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best rows: score falling, then id, then row."""
    order = np.lexsort((at, id, -score, query))
    sorted_query = query[order]
    first = np.searchsorted(sorted_query, sorted_query)
    return order[np.arange(len(order)) - first < k]


#: A k-th score that every score reaches.
LEAST = np.iinfo(np.int64).min


def block_bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """No row of a block scores more with a query: the sum of its components' best products with the block's extremes."""
    return _product(np.maximum(queries, 0), high) + _product(np.minimum(queries, 0), low)


def search_range(blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]], q_at: np.ndarray, queries: np.ndarray,
                 k: int, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(query place, score, id, row) of each query's k best in these blocks (of those that reach its ``start``), and the
    pairs of a query and a block that were scored."""
    high = np.stack([m.max(axis=0) for _, _, m in blocks])
    low = np.stack([m.min(axis=0) for _, _, m in blocks])
    bound = block_bounds(queries, high, low)
    order = np.argsort(-bound, axis=1, kind="stable")
    kth = np.full(len(queries), LEAST) if start is None else start.copy()
    held = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    scored = 0
    live = np.arange(len(queries))
    for turn in range(len(blocks)):
        block = order[live, turn]
        go = bound[live, block] >= kth[live]
        live, block = live[go], block[go]  # bounds only fall: a query that stops has ended
        if not len(live):
            break
        new = [held]
        for b in np.unique(block):
            ids, ats, m = blocks[b]
            some = live[block == b]
            scored += len(some)
            score = _product(queries[some], m)
            row, column = np.nonzero((score >= kth[some][:, None]) & (ats[None, :] != q_at[some][:, None]))
            new.append((some[row], score[row, column], ids[column], ats[column]))
        joined = [np.concatenate(x) for x in zip(*new)]
        best = _best(joined[0], joined[1], joined[2], joined[3], k)
        held = tuple(x[best] for x in joined)
        count = np.bincount(held[0], minlength=len(queries))
        last = np.cumsum(count) - 1  # held rows are ordered by query, then rank
        full = count == k
        kth[full] = np.maximum(kth[full], held[1][last[full]])
    return (*held, scored)


def top_k(table: DataFrame, is_query: Column, id: str = "vec_id", vector: str = "embedding", k: int = 5,
          scale: int = 256, range_rows: int = RANGE, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, vec_id, score) for each row of ``table`` where ``is_query`` (on column ``id``)."""
    spark = table.sparkSession
    vectors = stage(integer_vectors(table, id, vector, scale), "search-vectors")
    n, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    wanted = vectors.where(is_query)
    ranges = max(partitions(spark), math.ceil(n / range_rows))
    groups = max(1, math.ceil(wanted.count() / chunk))

    signs = F.lit(0)
    for d in range(min(_SIGNS, width)):
        signs = signs * 2 + F.when(F.try_element_at("v", F.lit(d + 1)) >= 0, 1).otherwise(0)
    laid = (vectors.withColumn("asked", F.coalesce(is_query, F.lit(False))).withColumn("order", signs)
            .repartitionByRange(ranges, "order", "id", "at")
            .sortWithinPartitions("order", "id", "at").withColumn("range", F.spark_partition_id()))
    packed = "int, number int, ids binary, ats binary, m binary"
    blocks = stage(laid.select("range", "id", "at", "v", "asked").mapInPandas(
        _packed(BLOCK, width, "range", k), f"range {packed}, high binary, low binary, q_ats binary, starts binary"),
        "search-blocks")
    starts = blocks.select(F.explode(_longs("q_ats", "starts")).alias("s")).select(
        F.col("s.q_at").alias("at"), F.col("s.start").alias("start"))
    chunks = stage(wanted.join(starts, "at").withColumn("grp", F.pmod(F.xxhash64("at"), F.lit(groups)).cast("int"))
                   .select("grp", "id", "at", "v", "start").groupBy("grp").applyInPandas(
                       _chunk(width), f"grp {packed}, starts binary"), "search-queries")

    # Every chunk meets the extremes of every range: the pair is the key on both sides.
    extremes = blocks.select("range", "high", "low").withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asking = chunks.withColumn("range", F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))))

    def reach(some: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(asked):
            return pd.DataFrame({"range": [], "grp": [], "places": []}).astype({"range": "int32", "grp": "int32"})
        high, low = (np.stack([np.frombuffer(x, dtype=np.int64) for x in some[c]]) for c in ("high", "low"))
        _, _, queries = _unpack(next(asked.itertuples()), width)
        start = np.frombuffer(asked["starts"].iloc[0], dtype=np.int64)
        places = np.flatnonzero(block_bounds(queries, high, low).max(axis=1) >= start)
        if not len(places):
            return pd.DataFrame({"range": [], "grp": [], "places": []}).astype({"range": "int32", "grp": "int32"})
        return pd.DataFrame({"range": [some["range"].iloc[0]], "grp": [asked["grp"].iloc[0]],
                             "places": [places.astype(np.int32).tobytes()]})

    reached = stage(extremes.groupBy("range", "grp").cogroup(asking.groupBy("range", "grp")).applyInPandas(
        reach, "range int, grp int, places binary"), "search-reached")
    left = blocks.select("range", "number", "ids", "ats", "m").join(reached.select("range", "grp"), "range")

    def only(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The queries of a chunk that a range can serve."""
        for part in parts:
            rows = []
            for r in part.itertuples():
                ids, ats, m = _unpack(r, width)
                places = np.frombuffer(r.places, dtype=np.int32)
                rows.append((r.range, r.grp, r.number, *[x[places].tobytes() for x in (
                    ids, ats, m, np.frombuffer(r.starts, dtype=np.int64))]))
            yield pd.DataFrame(rows, columns=["range", "grp", "number", "ids", "ats", "m", "starts"])

    right = chunks.join(reached, "grp").mapInPandas(only, f"range int, grp {packed}, starts binary")

    def meet(some: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        names = ["q_at", "query_id", "score", "vec_id", "at"]
        if not len(some) or not len(asked):
            return pd.DataFrame({c: np.zeros(0, dtype=np.int64) for c in names})
        held = [_unpack(r, width) for r in some.itertuples()]
        q_ids, q_ats, queries = (np.concatenate(x) for x in zip(*[_unpack(r, width) for r in asked.itertuples()]))
        start = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in asked["starts"]])
        of, score, ids, ats, _ = search_range(held, q_ats, queries, k, start)
        return pd.DataFrame(dict(zip(names, (q_ats[of], q_ids[of], score, ids, ats))))

    met = left.groupBy("range", "grp").cogroup(right.groupBy("range", "grp")).applyInPandas(
        meet, "q_at long, query_id long, score long, vec_id long, at long")
    rank = F.row_number().over(Window.partitionBy("q_at").orderBy(F.col("score").desc(), "vec_id", "at"))
    return (met.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _longs(keys: str, values: str) -> Column:
    """array<struct<q_at, start>> of two packed columns of 64-bit integers."""

    @F.pandas_udf("array<struct<q_at:long,start:long>>")
    def pairs(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([[{"q_at": int(x), "start": int(y)} for x, y in zip(
            np.frombuffer(i, dtype=np.int64), np.frombuffer(j, dtype=np.int64))] for i, j in zip(a, b)])

    return pairs(keys, values)


def _chunk(width: int):
    def one(rows: pd.DataFrame) -> pd.DataFrame:
        out = next(iter(_packed(len(rows), width, "grp")(iter([rows]))))
        return out.assign(starts=[rows["start"].to_numpy(np.int64).tobytes()])

    return one


def _unpack(row, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.ats, dtype=np.int64),
            np.frombuffer(row.m, dtype=np.int64).reshape(-1, width))
