"""Mixing sources to target weights by a min-cost flow over membership patterns.

1. Documents are aggregated by membership pattern (the set of sources a
   document belongs to; one source a document is the plain case).
2. Targets: the budget is dealt to the sources by weight; a source stops at
   ``max_repeats`` times its size and the excess is dealt again by weight.
3. A flow routes the patterns' words to the source quotas. A pattern's first
   pass over its words is free and every further pass costs more (convex), so
   repetition is spread over the patterns that a source can draw on. The
   network has a node for each pattern and source, no document.
4. Each pattern's flow is whole passes plus a rest. The rest is taken by
   documents in a seeded order: documents are dealt to seeded buckets of about
   ``BUCKET`` rows, bucket totals say which buckets are taken whole, and only
   the one bucket in which the rest ends is packed document by document.

Sizes are words (maximal runs without ASCII white space). A document is taken
whole, 0 to ``max_repeats`` times, so a source ends within one document of its
target. The order depends on seed, id and text only: reruns agree.

Nulls and odd rows: a null text has size 0; a null source is a source of its
own, sorted last; equal ids and repeated rows are separate documents; documents
of size 0 get whole passes only; an empty table gives an empty result; an input
column named like a result column gives way to it. The driver holds one row for
each membership pattern, never documents.
"""

from __future__ import annotations

import json
import math
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.llm.common import WORD, hold, others, partitions, put_away, q, stage

#: Rows of a seeded bucket on average.
BUCKET = 4096
_SWAPS = 8


def targets_by_weight(sizes: dict, weights: dict, budget: float, max_repeats: float) -> dict[object, float]:
    """Each source's target: weighted shares of ``budget``, capped, the excess dealt again."""
    target = {s: 0.0 for s in sizes}
    open_, left = {s for s in sizes if sizes[s] > 0 and weights[s] > 0}, float(budget)
    while open_ and left > 0:
        total = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / total >= max_repeats * sizes[s]}
        if not full:
            for s in open_:
                target[s] = left * weights[s] / total
            break
        for s in full:
            target[s] = float(max_repeats * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def min_cost_flow(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], passes: int) -> list[list[int]]:
    """Words that each pattern gives to each of its sources: ``patterns`` are (members, size).
    Successive cheapest paths; pass k of a pattern costs k for a word. Independent parts of
    the network are solved on their own."""
    flow = [[0] * len(members) for members, _ in patterns]
    parent = list(range(len(quotas)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for members, _ in patterns:
        for s in members[1:]:
            parent[root(s)] = root(members[0])
    parts: dict[int, list[int]] = {}
    for p, (members, _) in enumerate(patterns):
        parts.setdefault(root(members[0]), []).append(p)
    for part in parts.values():
        _augment(part, patterns, quotas, passes, flow)
    return flow


def _augment(part, patterns, quotas, passes, flow) -> None:
    taken = {p: 0 for p in part}
    got = {s: 0 for p in part for s in patterns[p][0]}
    users: dict[int, list[tuple[int, int]]] = {}
    for p in part:
        for k, s in enumerate(patterns[p][0]):
            users.setdefault(s, []).append((p, k))
    for level in range(passes):  # costs grow by pass: cheaper passes are filled first
        while True:
            # From every pattern with words left in this pass, over sources and
            # back along words given, to a source below its quota.
            came: dict = {}
            queue = deque()
            for p in part:
                if taken[p] < (level + 1) * patterns[p][1]:
                    came["p", p] = None
                    queue.append(("p", p))
            end = None
            while queue and end is None:
                kind, x = queue.popleft()
                if kind == "p":
                    for k, s in enumerate(patterns[x][0]):
                        if ("s", s) not in came:
                            came["s", s] = (x, k)
                            if got[s] < quotas[s]:
                                end = s
                                break
                            queue.append(("s", s))
                else:
                    for p, k in users[x]:
                        if flow[p][k] > 0 and ("p", p) not in came:
                            came["p", p] = (x, k)
                            queue.append(("p", p))
            if end is None:
                break
            path, s = [], end
            while True:
                p, k = came["s", s]
                back = came["p", p]
                path.append((p, k, back))
                if back is None:
                    break
                s = back[0]
            first = path[-1][0]
            amount = min([quotas[end] - got[end], (level + 1) * patterns[first][1] - taken[first]]
                         + [flow[p][back[1]] for p, _, back in path if back is not None])
            for p, k, back in path:
                flow[p][k] += amount
                if back is not None:
                    flow[p][back[1]] -= amount
            taken[first] += amount
            got[end] += amount


def _unit(seed: int, *columns: Column) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def _pack(part: pd.DataFrame) -> pd.DataFrame:
    """Takes documents in seeded order as far as they fit the room, then swaps a few to come nearer."""
    part = part.sort_values(["place", "at"], kind="stable")
    sizes, room = part["size"].to_numpy(), int(part["room"].iloc[0])
    chosen = np.zeros(len(sizes), dtype=bool)
    for i, n in enumerate(sizes.tolist()):
        if 0 < n <= room:
            chosen[i] = True
            room -= n
    for _ in range(_SWAPS):  # one more document, or one for another, while that comes nearer
        spare, taken = np.flatnonzero(~chosen & (sizes > 0)), np.flatnonzero(chosen)
        if not room or not len(spare):
            break
        taken = np.concatenate(([-1], taken[np.argsort(sizes[taken], kind="stable")]))
        less = np.where(taken < 0, 0, sizes[taken])
        near = np.clip(np.searchsorted(less, sizes[spare] - room), 1, len(less)) - 1
        best = None
        for step in (0, 1):
            other = np.minimum(near + step, len(less) - 1)
            gap = np.abs(room - (sizes[spare] - less[other]))
            i = int(gap.argmin())
            if best is None or gap[i] < best[0]:
                best = (int(gap[i]), int(spare[i]), int(taken[other[i]]), int(sizes[spare[i]] - less[other[i]]))
        if best[0] >= abs(room):
            break
        chosen[best[1]] = True
        if best[2] >= 0:
            chosen[best[2]] = False
        room -= best[3]
    return pd.DataFrame({"at": part["at"].to_numpy()[chosen]})


def mix_sources(docs: DataFrame, text: str = "text", id: str = "doc_id", source: str = "source",
                weights=(3, 1, 2), share: float = 1.5, max_repeats: int = 2, seed: int = 42,
                carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size`` and ``target`` (of its first source
    in code point order), ``taken`` (words) and ``copies``. ``source`` is a string column or an
    array of strings; ``weights`` repeat over the sources in code point order, null last."""
    new = ["size", "source_size", "target", "taken", "copies"]
    kept = others(docs, new) if carry is None else carry
    spark = docs.sparkSession
    away, back = put_away(kept)
    array = isinstance(docs.schema[source].dataType, T.ArrayType)
    members = F.array(q(source).cast("string"))
    if array:
        members = F.when(F.size(q(source)) > 0, F.array_sort(F.array_distinct(q(source)))).otherwise(
            F.array(F.lit(None).cast("string")))
    rows = hold(docs.select(*away, F.to_json(members).alias("members"),
                             F.coalesce(F.regexp_count(q(text), F.lit(WORD)), F.lit(0)).cast("long").alias("words"),
                             _unit(seed, q(id), q(text)).alias("place"),
                             F.monotonically_increasing_id().alias("at")))
    facts = stage(rows.select("members", "words", "place", "at"), "mix-facts")
    words, place, at = F.col("words"), F.col("place"), F.col("at")

    plan = _plan(spark, facts, weights, share, max_repeats)
    # Whole buckets of each pattern's seeded order, and the bucket in which its rest ends.
    dealt = _dealt(facts, plan)
    order = Window.partitionBy("p_members").orderBy("p_bucket")
    totals = (dealt.where("p_rest > 0").groupBy("p_members", "p_bucket", "p_rest").agg(F.sum(words).alias("n"))
              .withColumn("upto", F.sum("n").over(order)))
    cuts = (totals.where("upto - n < p_rest and upto >= p_rest")
            .select(F.col("p_members").alias("c_members"), F.col("p_bucket").alias("e_bucket"),
                    (F.col("p_rest") - (F.col("upto") - F.col("n"))).alias("room")))
    cut = _dealt(facts, plan.join(cuts, F.col("p_members") == F.col("c_members"), "left"))
    last = (cut.where("p_bucket = e_bucket")
            .select("p_members", "p_bucket", place.alias("place"), at.alias("at"), words.alias("size"), "room"))
    packed = (last.groupBy("p_members", "p_bucket").applyInPandas(_pack, "at long")
              .select(F.col("at").alias("s_at")))
    marked = cut.join(packed, at == F.col("s_at"), "left")
    extra = F.when(F.col("p_rest") == 0, 0).when(
        F.col("e_bucket").isNull() | (F.col("p_bucket") < F.col("e_bucket")), F.when(words > 0, 1).otherwise(0)).otherwise(
        F.when(F.col("s_at").isNotNull(), 1).otherwise(0))
    copies = (F.col("p_passes") + extra).cast("int")
    result = marked.select(at.alias("r_at"), words.alias("size"), F.col("p_source_size").alias("source_size"),
                           F.col("p_target").alias("target"), (copies * words).cast("long").alias("taken"),
                           copies.alias("copies"))
    return rows.join(result, F.col("at") == F.col("r_at")).select(*back, *new)


def _dealt(facts: DataFrame, plan: DataFrame) -> DataFrame:
    """``facts`` with their pattern's plan and seeded bucket. The join is salted on both
    sides: a pattern that holds a third of all rows is spread over every partition."""
    salts = partitions(facts.sparkSession)
    spread = plan.withColumn("p_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (facts.join(spread, (F.col("members") == F.col("p_members"))
                       & (F.pmod(F.hash("at"), F.lit(salts)) == F.col("p_salt"))).drop("p_salt")
            .withColumn("p_bucket", F.floor(F.col("place") * F.col("p_buckets")).cast("long")))


def _plan(spark, rows: DataFrame, weights, share: float, max_repeats: int) -> DataFrame:
    """One row a membership pattern: whole passes, the rest in words, buckets, and its source's facts."""
    found = rows.groupBy(F.col("members").alias("m")).agg(F.sum("words").alias("n"), F.count("*").alias("docs")).collect()
    sets = [tuple(json.loads(r["m"])) for r in found]
    sources = sorted({s for m in sets for s in m}, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(sources)}
    sizes = {i: 0 for i in range(len(sources))}
    for m, r in zip(sets, found):
        for s in m:
            sizes[number[s]] += r["n"]
    weight = {i: weights[i % len(weights)] for i in sizes}
    target = targets_by_weight(sizes, weight, share * sum(r["n"] for r in found), max_repeats)
    flow = min_cost_flow([(tuple(number[s] for s in m), r["n"]) for m, r in zip(sets, found)],
                         [round(target[i]) for i in sizes], max_repeats)
    out = []
    for m, r, given in zip(sets, found, flow):
        total, n, first = sum(given), r["n"], number[sorted(m, key=lambda s: (s is None, s or ""))[0]]
        passes, rest = (total // n, total % n) if n else (1, 0)
        out.append((r["m"], int(passes), int(rest), max(1, math.ceil(r["docs"] / BUCKET)), int(sizes[first]),
                    float(target[first])))
    return spark.createDataFrame(out, "p_members string, p_passes int, p_rest long, p_buckets long, "
                                      "p_source_size long, p_target double")


def mixed_documents(docs: DataFrame, text: str = "text", id: str = "doc_id", source: str = "source", **how) -> DataFrame:
    """The mix itself: every document as many times as it is taken, columns as they came."""
    names = docs.columns
    away, back = put_away(names)  # no clash with the columns that mixing adds
    text, id, source = (f"_in_{names.index(c)}" for c in (text, id, source))
    mixed = mix_sources(docs.select(*away), text, id, source, **how)
    again = F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("again")
    return mixed.select("*", again).select(*back)
