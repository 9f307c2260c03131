"""Quality classifier by importance resampling of hashed n-grams.

Two bag-of-n-grams models over ``BUCKETS`` hash buckets: one of target text
(labelled good) and one of raw text (all documents). A document's log
importance weight is the sum over its n-grams of log p_target - log p_raw, less
``threshold`` for each n-gram; the documents kept are the Gumbel top-k of these
weights: the k largest of weight + Gumbel noise, where k is the number of
documents whose mean log ratio reaches the threshold. The noise decides among
documents near the margin only (a few n-grams), and is seeded by id and text.

N-grams: words and runs of punctuation, lower-cased, one and two in a row; and
their shapes (case, digits, the punctuation itself, or "again" for a word that
repeats one of the last four), one to three in a row.

The target model and the threshold come from at most ``labelled`` labelled rows
of either class, taken in hash order (the documented bound); raw counts,
weights and k cover all documents. Counts are arrays of a fixed size per task,
summed by bucket.

Nulls and odd rows: a null or empty text has no n-gram and is rejected; rows
with null ids are scored like any other but never labelled; equal ids share a
label (the smallest quality given); without labels of both kinds nothing is
rejected but empty texts; an empty table gives an empty result; an input column
named like a result column gives way to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verlog.llm.common import caches_of, hold, others, put_away, q, small_batches, stage

BUCKETS = 1 << 14
#: Labelled rows of either class that the target model and the threshold are fitted on at most.
LABELLED = 5_000
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CACHE = 150_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


class _Tokens(dict):
    """Token -> its hash, the hash of its shape in the lower half."""

    def __missing__(self, token: str) -> tuple[int, int]:
        if token[0].isalnum() or token[0] == "_":
            if token.isdigit():
                shape = "0"
            elif token.isupper() and len(token) > 1:
                shape = "AA"
            elif token.islower():
                shape = "a"
            elif token[0].isupper() and token[1:].islower() or len(token) == 1:
                shape = "Aa"
            else:
                shape = "aA"
        else:
            shape = token[:4]
        both = (xxhash.xxh64_intdigest(token.lower()), xxhash.xxh64_intdigest(shape, 1))
        if len(self) >= _CACHE:
            self.clear()
        self[token] = both
        return both


@lru_cache(maxsize=1)
def _tokens() -> _Tokens:
    return _Tokens()


def _chained(hashes: np.ndarray, n: int, salt: int) -> np.ndarray:
    x = np.full(max(len(hashes) - n + 1, 0), salt, dtype=np.uint64)
    for k in range(n):
        x = (x ^ hashes[k:k + len(x)]) * _ODD
        x ^= x >> np.uint64(29)
    return (x * _STEP) >> np.uint64(50)


def buckets(text: str | None) -> np.ndarray:
    """The buckets of a text's n-grams, repeats included."""
    found = _TOKEN.findall(text or "")
    if not found:
        return np.zeros(0, dtype=np.int64)
    get = _tokens().__getitem__
    both = np.array(list(map(get, found)), dtype=np.uint64)
    words, shapes = both[:, 0], both[:, 1].copy()
    again = np.zeros(len(words), dtype=bool)
    for lag in range(1, 5):
        again[lag:] |= words[lag:] == words[:-lag]
    shapes[again] ^= np.uint64(0xA5A5A5A5A5A5A5A5)
    grams = [_chained(words, 1, 1), _chained(words, 2, 2), *[_chained(shapes, n, 2 + n) for n in (1, 2, 3)]]
    return np.concatenate(grams).astype(np.int64)


def labelled_sample(labels: DataFrame, id: str, quality: str, most: int) -> DataFrame:
    """At most ``most`` labelled ids of either class, in hash order: (l_id, l_good)."""
    one = (labels.where(q(id).isNotNull() & q(quality).isNotNull())
           .groupBy(q(id).cast("long").alias("l_id")).agg((F.min(q(quality)) > 0).alias("l_good")))
    order = F.xxhash64(F.lit(11), "l_id"), F.col("l_id")
    return one.where("l_good").orderBy(*order).limit(most).unionByName(
        one.where("not l_good").orderBy(*order).limit(most))


def _count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    caches_of("quality", _tokens.cache_clear)
    raw, good = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for part in parts:
        for text, label in zip(part["text"], part["good"]):
            found = np.bincount(buckets(text), minlength=BUCKETS)
            raw += found
            if label is not None and label == True:  # noqa: E712  (pandas may hand over numpy or null)
                good += found
    some = np.flatnonzero(raw)
    yield pd.DataFrame({"bucket": some, "raw": raw[some], "good": good[some]})


def fit(docs: DataFrame, sample: DataFrame, text: str, id: str) -> np.ndarray:
    """log p_target - log p_raw of each bucket."""
    tied = (docs.select(q(text).alias("text"), q(id).cast("long").alias("d_id"))
            .join(F.broadcast(sample), F.col("d_id") == F.col("l_id"), "left")
            .select("text", F.col("l_good").alias("good")))
    sums = (tied.mapInPandas(_count, "bucket long, raw long, good long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect())
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in sums:
        raw[r["bucket"]], good[r["bucket"]] = r["raw"], r["good"]
    if not good.sum():
        return np.zeros(BUCKETS)
    return (np.log((good + 0.5) / (good.sum() + 0.5 * BUCKETS)) - np.log((raw + 0.5) / (raw.sum() + 0.5 * BUCKETS)))


def best_threshold(means: np.ndarray, good: np.ndarray) -> float:
    """The cut of mean log ratios that separates the labelled rows best (balanced accuracy)."""
    if not good.any() or good.all():
        return -np.inf
    order = np.argsort(means)
    means, good = means[order], good[order]
    right = (np.concatenate(([0], np.cumsum(~good))) / (~good).sum()
             + 1 - np.concatenate(([0], np.cumsum(good))) / good.sum())
    edges = np.concatenate(([means[0] - 1], (means[1:] + means[:-1]) / 2, [means[-1] + 1]))
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return float(edges[best[len(best) // 2]])


def top_k(rows: DataFrame, key: str, k: int, ties: list[str], exact: int = 20_000) -> tuple[float, DataFrame]:
    """(edge, chosen rows): the k rows of largest ``key``. Every row above the edge is chosen;
    the returned frame holds the chosen rows that lie in the last bin, which is narrowed by
    counts until it holds at most ``exact`` rows."""
    low, high, n = rows.agg(F.min(key), F.max(key), F.count("*")).first()
    if low is None:
        return 0.0, rows.limit(0)
    above = 0
    for _ in range(8):
        if n <= exact or low == high:
            break
        bins, width = 1024, (high - low) / 1024
        if width == 0 or low + width == low:
            break
        place = F.least(F.floor((F.col(key) - low) / width), F.lit(bins - 1))
        counts = {r[0]: r[1:] for r in rows.where(F.col(key).between(low, high)).groupBy(place.alias("b"))
                  .agg(F.count("*"), F.min(key), F.max(key)).collect()}
        for b in sorted(counts, reverse=True):
            if above + counts[b][0] >= k:
                n, low, high = counts[b]
                break
            above += counts[b][0]
    inside = rows.where(F.col(key).between(low, high))
    if n > exact and low == high and ties:  # equal keys: the first by the next tie, found in the same way
        tied = inside.withColumn("_next", -F.col(ties[0]))
        edge, chosen = top_k(tied, "_next", k - above, ties[1:], exact)
        return high, chosen.unionByName(tied.where(F.col("_next") > edge)).drop("_next")
    rank = F.row_number().over(Window.orderBy(F.col(key).desc(), *[F.col(t) for t in ties]))
    return high, inside.withColumn("_rank", rank).where(F.col("_rank") <= k - above).drop("_rank")


def _noise(seed: int, *columns: Column) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id",
                   quality: str = "quality", labelled: int = LABELLED, seed: int = 42,
                   carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with ``n_grams``, ``log_ratio`` (mean over its n-grams) and ``kept``."""
    new = ["n_grams", "log_ratio", "kept"]
    kept = others(docs, new) if carry is None else carry
    small_batches(docs.sparkSession)
    sample = stage(labelled_sample(labels, id, quality, labelled), "quality-labels")
    ratio = docs.sparkSession.sparkContext.broadcast(fit(docs, sample, text, id))

    @F.pandas_udf("n long, mean double")
    def score(texts: pd.Series) -> pd.DataFrame:
        caches_of("quality", _tokens.cache_clear)
        out = []
        for t in texts:
            found = buckets(t)
            out.append((len(found), float(ratio.value[found].mean()) if len(found) else 0.0))
        return pd.DataFrame(out, columns=["n", "mean"])

    away, back = put_away(kept)
    rows = hold(docs.select(*away, q(id).cast("long").alias("own_id"), score(q(text)).alias("scored"),
                             _noise(seed, q(id), q(text)).alias("noise"),
                             F.monotonically_increasing_id().alias("at")))
    facts = stage(rows.select("own_id", "scored", "noise", "at"), "quality-facts")
    n, mean = F.col("scored.n"), F.col("scored.mean")
    # A row for each labelled id, however many documents have it.
    known = (facts.where(n > 0).join(F.broadcast(sample), F.col("own_id") == F.col("l_id"))
             .groupBy("l_id").agg(F.avg(mean), F.first("l_good").alias("l_good")).drop("l_id").toPandas())
    threshold = best_threshold(known.iloc[:, 0].to_numpy(dtype=float), known["l_good"].to_numpy(dtype=bool))
    floor = threshold if np.isfinite(threshold) else -1e300
    weight = n * (mean - F.lit(floor)) if np.isfinite(threshold) else F.lit(0.0)
    keyed = facts.where(n > 0).select("at", mean.alias("mean"), (weight + F.col("noise")).alias("key"))
    k = keyed.where(F.col("mean") >= floor).count()
    edge, last = top_k(keyed.select("at", "key"), "key", k, ["at"])
    chosen = last.select(F.col("at").alias("s_at"))
    return (rows.join(chosen, F.col("at") == F.col("s_at"), "left")
            .select(*back, n.alias("n_grams"), mean.alias("log_ratio"),
                    ((n > 0) & (F.col("s_at").isNotNull() | (weight + F.col("noise") > F.lit(edge)))
                     & F.lit(k > 0)).alias("kept")))


def good_documents(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, columns as they came."""
    away, back = put_away(docs.columns)
    inner_text, inner_id = (f"_in_{docs.columns.index(c)}" for c in (text, id))
    tied = labels.select(q(id).alias(inner_id), "quality")
    return quality_scores(docs.select(*away), tied, inner_text, inner_id).where("kept").select(*back)
