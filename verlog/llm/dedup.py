"""Exact duplicates through a minimal perfect hash over historical digests.

Texts are equal when their SHA-256 over the text with each run of ASCII white
space replaced by one space is equal. The table is taken in two arrivals, the
lower and the upper half of the id range (``history`` may name another split):

1. The distinct digests of the first arrival become the index. They are dealt
   by digest prefix into segments of bounded size; each segment is a minimal
   perfect hash (levels of collision-free bits, rank = slot) whose slots hold
   the full digest and the winner's locator (id and row number).
2. The second arrival, already reduced to one row per digest, is looked up.
   A perfect hash sends strangers to arbitrary slots, so all 32 bytes of the
   slot's digest are compared. Members are repeats of the winner that the slot
   holds, and take its id and row from there; the rest group by themselves.

No step handles the copies of one text as a group: counts and winners are
map-side aggregates, group sizes are joined to winners by digest, and decisions
go back to rows by a plain join on the digest and the arrival, which Spark splits where one digest is frequent.

Nulls and odd rows: a null text counts as empty; rows with a null id belong to
the second arrival and win only if no row of their group has an id; equal ids
and repeated rows are resolved by row position, so exactly one row stays; an
empty table gives an empty result; an input column named like a result column
gives way to it.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verlog.llm.common import hold, others, pieces_for, put_away, q, stage

#: Distinct digests a segment of the index holds on average at most.
SEGMENT = 65_536
_GAMMA, _MAX_LEVELS = 2.0, 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _hash(low: np.ndarray, high: np.ndarray, level: int, size: int) -> np.ndarray:
    x = (low ^ (high + np.uint64(level)) * _MIX) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return ((x >> np.uint64(11)) % np.uint64(size)).astype(np.int64)


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 32)
    words = np.ascontiguousarray(raw[:, 8:24]).view("<u8")
    return raw, words[:, 0].copy(), words[:, 1].copy()


class Segment:
    """A minimal perfect hash over one segment's digests, and its slots."""

    def __init__(self, levels: list[np.ndarray], digests: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        self.levels, self.digests, self.ids, self.rows = levels, digests, ids, rows
        flat = np.concatenate([*levels, np.zeros(1, dtype=bool)])
        self.rank = np.cumsum(flat) - flat
        self.base = np.concatenate(([0], np.cumsum([len(x) for x in levels]))).astype(np.int64)

    @staticmethod
    def build(digests: list[bytes], ids, rows) -> Segment:
        raw, low, high = _halves(digests)
        left, levels, place = np.arange(len(raw)), [], np.zeros(len(raw), dtype=np.int64)
        while len(left):
            if len(levels) == _MAX_LEVELS:
                raise ValueError("digests of a segment are not distinct")
            size = max(8, int(_GAMMA * len(left)))
            at = _hash(low[left], high[left], len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            place[left[alone[at]]] = at[alone[at]] + sum(len(x) for x in levels)
            levels.append(alone)
            left = left[~alone[at]]
        made = Segment(levels, raw, np.asarray(ids, np.int64), np.asarray(rows, np.int64))
        order = np.empty(len(raw), dtype=np.int64)
        order[made.rank[place]] = np.arange(len(raw))
        made.digests, made.ids, made.rows = raw[order], made.ids[order], made.rows[order]
        return made

    def find(self, digests: list[bytes]) -> np.ndarray:
        """Each digest's slot, or -1 for strangers."""
        raw, low, high = _halves(digests)
        slot = np.full(len(raw), -1, dtype=np.int64)
        left = np.arange(len(raw))
        for k, bits in enumerate(self.levels):
            at = _hash(low[left], high[left], k, len(bits))
            hit = bits[at]
            slot[left[hit]] = self.rank[self.base[k] + at[hit]]
            left = left[~hit]
        held = slot >= 0
        same = np.zeros(len(raw), dtype=bool)
        same[held] = (self.digests[slot[held]] == raw[held]).all(axis=1)
        return np.where(same, slot, -1)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bits=np.packbits(np.concatenate(self.levels)), sizes=np.array([len(x) for x in self.levels]),
                 digests=self.digests, ids=self.ids, rows=self.rows)
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Segment:
        with np.load(io.BytesIO(data)) as z:
            flat = np.unpackbits(z["bits"])[: z["sizes"].sum()].astype(bool)
            return Segment(np.split(flat, np.cumsum(z["sizes"])[:-1]), z["digests"], z["ids"], z["rows"])


def _segment(digest: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(n)).cast("int")


def build_index(winners: DataFrame, segments: int) -> DataFrame:
    """(segment, index) from distinct ``digest`` (binary), ``id``, ``at``."""

    def make(part: pd.DataFrame) -> pd.DataFrame:
        made = Segment.build(list(part["digest"]), part["id"], part["at"])
        return pd.DataFrame({"segment": [part["segment"].iloc[0]], "index": [made.dump()]})

    return (winners.withColumn("segment", _segment(F.col("digest"), segments))
            .groupBy("segment").applyInPandas(make, "segment int, index binary"))


def look_up(groups: DataFrame, index: DataFrame, segments: int) -> DataFrame:
    """``groups`` (digest, id, at, n) with ``member`` and the slot's ``old_id`` and ``old_at``."""

    def find(part: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = part.drop(columns="segment")
        slot = np.full(len(part), -1, dtype=np.int64)
        if len(held) and len(part):
            known = Segment.load(held["index"].iloc[0])
            slot = known.find(list(part["digest"]))
            out["old_id"] = pd.array(known.ids[slot], dtype="Int64")
            out["old_at"] = pd.array(known.rows[slot], dtype="Int64")
            out.loc[slot < 0, ["old_id", "old_at"]] = pd.NA
        else:
            out["old_id"] = pd.array([pd.NA] * len(part), dtype="Int64")
            out["old_at"] = pd.array([pd.NA] * len(part), dtype="Int64")
        out["member"] = slot >= 0
        return out

    dealt = groups.withColumn("segment", _segment(F.col("digest"), segments))
    return dealt.groupBy("segment").cogroup(index.groupBy("segment")).applyInPandas(
        find, "digest binary, id long, at long, n long, old_id long, old_at long, member boolean")


def exact_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", carry: list[str] | None = None,
                     history: Column | None = None, segment: int = SEGMENT) -> DataFrame:
    """Every row of ``docs`` with ``keep_id`` (id of the row that stays), ``group_size``,
    ``kept`` and ``text_sha256``. ``carry`` names the input columns to return (default:
    all). ``history`` is true for the rows of the first arrival; winners come from it,
    so it must hold smaller ids than the rest (default: the lower half of the id range)."""
    new = ["keep_id", "group_size", "kept", "text_sha256"]
    kept = others(docs, new) if carry is None else carry
    away, back = put_away(kept)
    if history is None:
        ends = docs.agg(F.min(q(id)), F.max(q(id))).first()
        history = q(id) <= F.lit((ends[0] + ends[1]) // 2) if ends[0] is not None else F.lit(False)
    rows = hold(docs.select(*away, q(id).cast("long").alias("id"),
                             F.unhex(F.sha2(normalised(q(text)), 256)).alias("digest"),
                             (F.coalesce(history, F.lit(False)) & q(id).isNotNull()).alias("old"),
                             F.monotonically_increasing_id().alias("at")))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at"))
    groups = stage(rows.groupBy("digest", "old")
                   .agg(first.alias("first"), F.count("*").alias("n"))
                   .select("digest", "old", "first.id", "first.at", "n"), "dedup-groups")
    past, new_groups = groups.where("old").drop("old"), groups.where("not old").drop("old")
    segments = pieces_for(past.count(), segment, docs.sparkSession)
    index = stage(build_index(past, segments), "dedup-index")
    seen = stage(look_up(new_groups, index, segments), "dedup-seen")

    # Winners: the first arrival's own, a repeat's from its slot, a stranger's own. Only sizes are joined by digest.
    sizes = groups.groupBy(F.col("digest").alias("s_digest")).agg(F.sum("n").alias("g_n"))
    winners = (past.select("digest", F.lit(True).alias("old"), "id", "at")
               .unionByName(seen.select("digest", F.lit(False).alias("old"),
                                        F.when(F.col("member"), F.col("old_id")).otherwise(F.col("id")).alias("id"),
                                        F.when(F.col("member"), F.col("old_at")).otherwise(F.col("at")).alias("at"))))
    found = (winners.join(sizes, F.col("digest") == F.col("s_digest"))
             .select(F.col("digest").alias("g_digest"), F.col("old").alias("g_old"), F.col("id").alias("g_id"),
                     F.col("at").alias("g_at"), "g_n"))
    return (rows.join(found, (F.col("digest") == F.col("g_digest")) & (F.col("old") == F.col("g_old")))
            .select(*back, F.col("g_id").alias("keep_id"), F.col("g_n").alias("group_size"),
                    (F.col("at") == F.col("g_at")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")))


def without_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay."""
    away, back = put_away(docs.columns)
    text, id = (f"_in_{docs.columns.index(c)}" for c in (text, id))
    return exact_duplicates(docs.select(*away), text, id).where("kept").select(*back)
