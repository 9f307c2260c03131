"""SimHash near-duplicate groups: pigeonhole blocks, then a Hamming check.

Fingerprints are linked when they differ in at most ``max_bits`` bits. The 64
bits are cut into ``r`` blocks; two linked fingerprints agree on at least
``r - max_bits`` of them, so every choice of that many blocks is one join key
(``r`` grows with the logarithm of the number of fingerprints, so that a key
has a few more bits than are needed to tell that many random fingerprints
apart). Work runs on distinct fingerprints only: copies share one.

A block that holds more than ``hot`` fingerprints is not joined to itself. Its
rows are cut again on the bits that the key leaves free, into finer blocks by
the same rule, until no block is large or the free bits are used up; the few
that stay large after that hold fingerprints which all lie in a small Hamming
ball, and these are linked through shared midpoints (two fingerprints at most
``max_bits`` apart have a common neighbour at most ``ceil(max_bits / 2)`` bits
from both), which is linear in the block. No link is lost on either way.

Groups are the connected components of the links (alternating large-star and
small-star rounds on the edges, each round written to the shared folder).

Nulls and odd rows: a null text counts as empty; a text without words has
fingerprint zero and is linked like any other; rows with a null id take part
and get their group's smallest non-null id (null if the group has none);
repeated rows and equal ids are kept as they are; an empty table gives an empty
result; an input column named like a result column gives way to it.
"""

from __future__ import annotations

import math
import re
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.llm.common import WORD, hold, others, put_away, q, small_batches, stage
from verlog.llm.components import connected_components

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_WORD = re.compile(WORD.encode())
#: Shingles hashed at once, to bound the unpacked bits of a long text.
_SLICE = 1 << 16


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of one text."""
    data = (text or "").encode("utf-8").translate(_LOWER)
    tokens = _WORD.findall(data)
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    k = min(words, len(tokens))
    lo = np.concatenate(([0], ends[:-1] + 1))[: len(tokens) - k + 1].tolist()
    hi = ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(lo), _SLICE):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(lo[at:at + _SLICE], hi[at:at + _SLICE])],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255  # sums of up to 255 bits fit a byte
        counts += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * counts > len(lo)))


def fingerprint_column(text: Column, words: int = 4, seed: int = 42) -> Column:
    """The fingerprint as a signed long with the same bits."""

    @F.pandas_udf(T.LongType())
    def one(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words, seed) for t in texts], dtype=np.uint64).view(np.int64))

    return one(text)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _cut(bits: list[int], r: int, keep: int) -> list[list[int]]:
    """The bit lists of every choice of ``keep`` out of ``r`` blocks of ``bits``."""
    edges = [len(bits) * i // r for i in range(r + 1)]
    return [[b for i in choice for b in bits[edges[i]:edges[i + 1]]] for choice in combinations(range(r), keep)]


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def _blocks_for(n: int, bits: int, max_bits: int) -> int:
    """Smallest number of blocks whose keys are two bits longer than log2(n)."""
    need = math.log2(max(n, 2)) + 2
    r = max_bits + 1
    while r < bits and bits * (r - max_bits) / r < need and math.comb(r + 1, max_bits) <= 500:
        r += 1
    return r


def _verified(blocks: DataFrame, on: list[str], max_bits: int) -> DataFrame:
    a, b = blocks.alias("a"), blocks.alias("b")
    return a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in on]
                  + [F.col("a.fp") < F.col("b.fp"),
                     F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits]
                  ).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))


def _split(blocks: DataFrame, on: list[str], hot: int) -> tuple[DataFrame, DataFrame]:
    sizes = blocks.groupBy(*on).agg(F.count("*").alias("n")).where("n > 1")
    sized = blocks.join(sizes, on)
    return sized.where(F.col("n") <= hot).drop("n"), sized.where(F.col("n") > hot).drop("n")


def links(vertices: DataFrame, n: int, max_bits: int = 4, hot: int = 256) -> DataFrame:
    """Edges ``u < v`` (signed) between the distinct fingerprints of ``vertices`` (column ``fp``)
    whose components are those of all pairs at most ``max_bits`` apart."""
    spark = vertices.sparkSession
    if max_bits == 0:
        return spark.createDataFrame([], "u long, v long")
    r = _blocks_for(n, 64, max_bits)
    keys = _cut(list(range(64)), r, r - max_bits)
    masks = F.array(*[F.struct(F.lit(i).alias("m"), F.lit(_mask(k)).cast("long").alias("mask"))
                      for i, k in enumerate(keys)])
    blocks = (vertices.select("fp", F.explode(masks).alias("k"))
              .select("fp", "k.m", F.col("fp").bitwiseAND(F.col("k.mask")).alias("key")))
    cold, large = _split(blocks, ["m", "key"], hot)
    found = [_verified(cold, ["m", "key"], max_bits)]

    large = stage(large, "simhash-large")
    if large.take(1):
        fine, free = [], []
        for i, k in enumerate(keys):
            rest = [b for b in range(64) if b not in set(k)]
            r2 = min(2 * max_bits, len(rest))
            for j, sub in enumerate(_cut(rest, r2, max(r2 - max_bits, 0))):
                fine.append((i, j, _mask(sub)))
                free.append((i, j, [_mask([b]) for b in rest if b not in set(sub)]))
        finer = spark.createDataFrame(fine, "m int, m2 int, mask long")
        blocks = (large.join(F.broadcast(finer), "m")
                  .select("fp", "m", "key", "m2", F.col("fp").bitwiseAND(F.col("mask")).alias("key2")))
        on = ["m", "key", "m2", "key2"]
        cold, ball = _split(blocks, on, hot)
        found.append(_verified(cold, on, max_bits))
        found.append(_through_midpoints(ball, on, spark.createDataFrame(free, "m int, m2 int, bits array<long>"),
                                        max_bits))
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges.distinct()


def _through_midpoints(ball: DataFrame, on: list[str], free: DataFrame, max_bits: int) -> DataFrame:
    """Links each member of a midpoint to the midpoint's smallest near member."""
    near, far = max_bits // 2, (max_bits + 1) // 2
    rows = ball.join(F.broadcast(free), ["m", "m2"])
    flips = rows.select(*on, "fp", "bits", F.lit(0).alias("w"), F.lit(-1).alias("last"), F.col("fp").alias("mid"))
    every = flips
    for _ in range(far):
        flips = (flips.select(*on, "fp", "bits", "w", "last", "mid", F.posexplode("bits").alias("i", "bit"))
                 .where("i > last")
                 .select(*on, "fp", "bits", (F.col("w") + 1).alias("w"), F.col("i").alias("last"),
                         F.col("mid").bitwiseXOR(F.col("bit")).alias("mid")))
        every = every.unionByName(flips)
    at = [*on, "mid"]
    first = (every.where(F.col("w") <= near).groupBy(*at).agg(F.min("fp").alias("first")))
    return (every.join(first, at).where("fp <> first")
            .select(F.least("fp", "first").alias("u"), F.greatest("fp", "first").alias("v")))


def simhash_groups(docs: DataFrame, text: str = "text", id: str = "doc_id", words: int = 4, max_bits: int = 4,
                   carry: list[str] | None = None, hot: int = 256) -> DataFrame:
    """Every row of ``docs`` with ``fingerprint`` (16 hex digits), ``component_id`` (smallest
    id of its group) and ``keeper`` (true for one row of each group: the smallest id, nulls
    last, the first such row). ``carry`` names the input columns to return (default: all)."""
    new = ["fingerprint", "component_id", "keeper"]
    kept = others(docs, new) if carry is None else carry
    away, back = put_away(kept)
    small_batches(docs.sparkSession)
    rows = hold(docs.select(*away, q(id).alias("id"), fingerprint_column(q(text), words).alias("fp"),
                             F.monotonically_increasing_id().alias("at")))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at"))
    vertices = stage(rows.groupBy("fp").agg(first.alias("first")), "simhash-vertices")
    edges = stage(links(vertices.select("fp"), vertices.count(), max_bits, hot), "simhash-links")
    roots = connected_components(edges)
    labelled = (vertices.join(roots, vertices["fp"] == roots["node"], "left")
                .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    groups = labelled.groupBy("root").agg(F.min("first").alias("lead"))
    label = labelled.join(groups, "root").select("fp", "lead")
    return (rows.join(label, "fp")
            .select(*back, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.col("lead.id").alias("component_id"), (F.col("at") == F.col("lead.at")).alias("keeper")))


def one_per_group(docs: DataFrame, text: str = "text", id: str = "doc_id", words: int = 4,
                  max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay: one of each near-duplicate group."""
    away, back = put_away(docs.columns)
    text, id = (f"_in_{docs.columns.index(c)}" for c in (text, id))
    return simhash_groups(docs.select(*away), text, id, words, max_bits).where("keeper").select(*back)
