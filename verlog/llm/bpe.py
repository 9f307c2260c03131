"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Piece boundaries come from ``pretokens``: class arrays of code points and
associative scans over an automaton's transition functions, no regular
expression.

The pieces are byte slices of the text. Each distinct piece is merged once by
rank (short pieces by repeated scans, long ones with a heap) and kept in a
bounded cache of the worker. The slices' byte places are kept: with the tokens'
byte lengths inside a slice they give the offsets at which a round trip puts
the decoded bytes.

Nulls and odd rows: a null text counts as empty and gives no ids; repeated rows
and null ids of documents pass through; very long texts are encoded whole; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verlog.llm.common import caches_of, others, put_away, q, small_batches
from verlog.llm.pretokens import batches, cut

#: Pieces a worker keeps, and the longest of them in bytes.
_CACHE, _SHORT = 250_000, 48
#: Tokens decoded together.
_TOGETHER = 1 << 16


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: always merge the leftmost pair of lowest rank."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > 64:
        return _merge_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, where = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, where = rank, i
        if best is None:
            break
        parts[where:where + 2] = [parts[where] + parts[where + 1]]
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(piece)
    end, prev = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def push(i: int) -> None:
        j = end[i]
        if j < n:
            rank = ranks.get(piece[i:end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n):
        push(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue  # one of its parts has been merged meanwhile
        j = end[i]
        alive[j], end[i] = False, stop
        if stop < n:
            prev[stop] = i
        push(i)
        if prev[i] >= 0:
            push(prev[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Merges:
    """Merges many pieces side by side: row i of a matrix holds the parts of piece i,
    and each round merges every row's leftmost pair of lowest rank."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.full(256, -1, dtype=np.int32)
        pairs = {}
        for token, rank in ranks.items():
            if len(token) == 1:
                self.single[token[0]] = rank
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (right >= 0), self.values[at], self.NONE)

    def many(self, pieces: list[bytes]) -> list[bytes]:
        """The packed ids of pieces of at most ``_SHORT`` bytes."""
        out: list[bytes] = [b""] * len(pieces)
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            known = self.ranks.get(p)
            if known is not None:
                out[i] = known.to_bytes(4, "little")
            else:
                by_length.setdefault(len(p), []).append(i)
        for length, where in by_length.items():
            raw = np.frombuffer(b"".join([pieces[i] for i in where]), dtype=np.uint8).reshape(-1, length)
            self._rounds(self.single[raw], np.array(where), out)
        return out

    def _rounds(self, parts: np.ndarray, where: np.ndarray, out: list[bytes]) -> None:
        rank = self.rank(parts[:, :-1], parts[:, 1:])
        while len(parts):
            at = rank.argmin(axis=1)
            lowest = rank[np.arange(len(rank)), at]
            over = lowest == self.NONE
            if over.any():
                width = parts.shape[1] * 4
                packed = np.ascontiguousarray(parts[over].astype("<u4")).tobytes()
                for k, i in enumerate(where[over].tolist()):
                    out[i] = packed[k * width:(k + 1) * width]
                live = ~over
                parts, rank, where, at, lowest = parts[live], rank[live], where[live], at[live], lowest[live]
                if not len(parts):
                    return
            rows = np.arange(len(parts))
            parts[rows, at] = lowest
            columns = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, columns + (columns > at[:, None]), axis=1)
            if parts.shape[1] == 1:
                packed = parts.astype("<u4").tobytes()
                for k, i in enumerate(where.tolist()):
                    out[i] = packed[k * 4:k * 4 + 4]
                return
            columns = columns[:-1]
            rank = np.take_along_axis(rank, columns + (columns >= at[:, None]), axis=1)
            left = at > 0
            r = rows[left]
            rank[r, at[left] - 1] = self.rank(parts[r, at[left] - 1], parts[r, at[left]])
            right = at < parts.shape[1] - 1
            r = rows[right]
            rank[r, at[right]] = self.rank(parts[r, at[right]], parts[r, at[right] + 1])


class _Pieces(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.merges = ranks, Merges(ranks)

    def learn(self, pieces: list[bytes]) -> None:
        """Makes room, then merges the short pieces not held yet."""
        new = [p for p in set(pieces) if p not in self and len(p) <= _SHORT]
        if len(self) + len(new) > _CACHE:
            self.clear()
            new = [p for p in set(pieces) if len(p) <= _SHORT]
        self.update(zip(new, self.merges.many(new)))

    def __missing__(self, piece: bytes) -> bytes:
        return np.array(merge(piece, self.ranks), dtype="<u4").tobytes()


class Codec:
    """Encoder and decoder for one rank file."""

    def __init__(self, path: str):
        ranks = load_ranks(path)
        self.pieces = _Pieces(ranks)
        self.vocabulary = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.vocabulary[rank] = piece
        self.lengths = np.array([len(p) for p in self.vocabulary], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.vocabulary), dtype=np.uint8)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        return [packed for packed, _ in self.encode_placed(texts, slices=False)]

    def encode_placed(self, texts: list[str], slices: bool = True) -> Iterator[tuple[bytes, np.ndarray | None]]:
        """The packed ids of each text, and the byte place in the text and token count of each of its slices."""
        get = self.pieces.__getitem__
        for some in batches(texts):
            cuts = cut(some, as_bytes=True)
            self.pieces.learn([p for c in cuts for p in c])
            for c in cuts:
                coded = list(map(get, c))
                yield b"".join(coded), self._slices(c, coded) if slices else None

    @staticmethod
    def _slices(cuts: list[bytes], coded: list[bytes]) -> np.ndarray:
        ends = np.cumsum(np.fromiter(map(len, cuts), np.int64, len(cuts)))
        counts = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        return np.stack([np.concatenate(([0], ends))[:-1] if len(ends) else ends, counts])

    def placed(self, ids: np.ndarray, slices: np.ndarray) -> np.ndarray:
        """Byte place of each token in the text: its slice's, and after the tokens before it there."""
        place, counts = slices
        inside = np.cumsum(self.lengths[ids]) - self.lengths[ids]
        some = counts > 0
        first = (np.cumsum(counts) - counts)[some]
        return inside + np.repeat(place[some] - inside[first], counts[some])

    def decode_placed(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of ids, each token's at its offset; bytes that no token covers are zero."""
        lengths = self.lengths[ids]
        out = np.zeros(int((offsets + lengths).max()) if len(ids) else 0, dtype=np.uint8)
        for at in range(0, len(ids), _TOGETHER):  # the index arrays of a long text stay small
            i, n, to = ids[at:at + _TOGETHER], lengths[at:at + _TOGETHER], offsets[at:at + _TOGETHER]
            begin = np.cumsum(n) - n
            step = np.arange(n.sum())
            out[step + np.repeat(to - begin, n)] = self.flat[step + np.repeat(self.starts[i] - begin, n)]
        return out.tobytes()

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte place of each token, and the end of the last."""
        return np.concatenate(([0], np.cumsum(self.lengths[ids])))

    def decode(self, ids: np.ndarray) -> bytes:
        vocabulary = self.vocabulary
        return b"".join([vocabulary[i] for i in ids.tolist()])


@lru_cache(maxsize=4)
def _codec(path: str) -> Codec:
    return Codec(path)


def codec(path: str) -> Codec:
    caches_of("bpe", _codec.cache_clear)
    return _codec(path)


def encoded(text: Column, path: str) -> Column:
    """struct(ids binary: little-endian unsigned 32-bit, offsets binary: same, one longer)."""

    @F.pandas_udf("ids binary, offsets binary")
    def one(texts: pd.Series) -> pd.DataFrame:
        tool = codec(path)
        ids = tool.encode([t or "" for t in texts])
        return pd.DataFrame({"ids": ids, "offsets": [tool.offsets(np.frombuffer(x, "<u4")).astype("<u4").tobytes()
                                                     for x in ids]})

    return one(text)


def decoded(ids: Column, path: str) -> Column:
    """The bytes of packed ids (null for null)."""

    @F.pandas_udf("binary")
    def one(packed: pd.Series) -> pd.Series:
        tool = codec(path)
        return pd.Series([None if x is None else tool.decode(np.frombuffer(x, "<u4")) for x in packed], dtype=object)

    return one(ids)


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``ids`` and ``offsets`` (clashing input columns give way)."""
    kept = others(docs, ["ids", "offsets"])
    away, back = put_away(kept)
    return docs.select(*away, encoded(q(text), path).alias("coded")).select(*back, "coded.ids", "coded.offsets")


def round_trip(text: Column, path: str) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256): encodes, then decodes the ids by the offsets kept from the slices."""
    small_batches(SparkSession.getActiveSession())

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def one(texts: pd.Series) -> pd.DataFrame:
        tool = codec(path)
        rows = []
        for packed, slices in tool.encode_placed([t or "" for t in texts]):
            ids = np.frombuffer(packed, "<u4")
            decoded = tool.decode_placed(ids, tool.placed(ids, slices))
            rows.append((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return one(text)
