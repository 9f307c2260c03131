"""Token-ID files: an adaptive context-mixing range coder in independent blocks.

Documents are tokenised, dealt by id into ranges and written in ascending id
order. A file row is a chunk of consecutive whole documents: their ids and
token counts, and the chunk's ids coded in blocks of ``BLOCK``. Blocks are coded
in groups of at most 4,096. A group has a checksummed start: its ids with
their counts, by which they are ranked and dealt to classes of about equal weight, and
counts of which class follows which. Every block starts afresh from it and carries its length and CRC-32, so
blocks decode on their own, and a damaged one is found.

Model: an order-2 and an order-1 context (the last two ids, the last id) each
predict one id with a confidence that grows while the prediction comes true and
falls when it fails; the confidences set the weights. What they leave goes to
counts on two levels, the id's class and, evenly, the id in its class, whose ids weigh
about the same. The class is a mix of
the start's order-1 counts (by the last id's class) and of the block's own adaptive
order-0 counts. The mixed distribution drives a range coder (62-bit range, 32-bit
words, carries resolved at the end). All blocks of a group are coded side by
side, one id of each block a step. The coder's quotients are exact or rounded once, so the
decoder repeats them exactly.

The files are Parquet rows written by Spark: any store that Spark writes to
will do, and a lost task is written again.

Nulls and odd rows: a null text counts as empty; an empty text is its end id
alone; null ids come first; equal ids and repeated rows keep some fixed order;
a very long document makes one long chunk of many groups, coded one after
another; an empty table gives no files and an empty result; extra columns are
ignored. Vocabularies of more than 65,536 ids are refused.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from string import punctuation

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verlog.llm.common import partitions, q, small_batches, stage
from verlog.llm.pretokens import batches
from verlog.llm.token_count import _byte_letters, _unknown

BLOCK = 2048
#: Ids of a chunk, at least, before the next document starts a new one.
CHUNK = 1 << 23
MAGIC = b"VTK3"

_ONE = 1 << 16  # the whole of a step's weights
_SLOTS1, _SLOTS2, _LEVELS = 128, 256, 8
_CLASSES, _GROUP = 256, 4096  # classes of ids at most; blocks that are coded side by side at most
_STATIC, _OWN = (3 << 14) - 1, 1 << 14  # the shares of the start's counts and of the block's own, 2 ** 16 - 1 in all
_EVEN = 3 << 10  # what the static share deals evenly to all ids
_REFRESH, _TOGETHER = 512, 128  # steps between, and blocks at a time, when a block's own counts become edges
_EARLY = (2, 8, 32, 96, 256)
_TOP, _RANGE, _WORD = 1 << 62, 1 << 30, (1 << 30) - 1  # the coder's range; 32-bit words
_FINE = 28  # bits of a step's distribution
_UP = _FINE - 16
_SPAN = 1 << 18  # ids that are counted at once
_FAN, _LAST = 16, (1 << 16) - 2  # edges compared at once by the decoder; the last number that an id can have
#: Counts are kept by their logarithms, in eighths of a bit.
_KEPT_COUNTS = np.array([0] + [int(2 ** (k / 8)) for k in range(255)], dtype=np.int64)


def _weights() -> tuple[np.ndarray, np.ndarray]:
    """Shares of order 2's and of both predictions by their confidences (order-2's times 8, plus order-1's): a
    prediction that came true k times running weighs (k + 0.1) / (k + 2), at most 3/4; order 1 has that
    share of what order 2 leaves, at most a half, so at least 1/8 stays for the counts. The upper half
    of the places is for predictions that agree: order 2's share is then both."""
    weight = [min((k + 0.1) / (k + 2), 0.75) for k in range(_LEVELS)]
    second = [int(_ONE * weight[k2]) for k2 in range(_LEVELS) for _ in range(_LEVELS)]
    both = [m2 + int((_ONE - m2) * min(weight[k1], 0.5)) for m2, k1 in zip(second, list(range(_LEVELS)) * _LEVELS)]
    return np.array(second + both, dtype=np.int64), np.array(both + both, dtype=np.int64)


_SECOND, _KNOWN = _weights()
_SHARES = _SECOND << 17 | _KNOWN
_MASKS = np.array([[_SLOTS1 - 1], [_SLOTS2 - 1]])
#: What a slot gains by its confidence, where its prediction fails and (from 8 on) where it comes true.
_GAIN = np.array([(k >> 1) - k for k in range(_LEVELS)] + [int(k < _LEVELS - 1) for k in range(_LEVELS)], dtype=np.int32)


def _logs(counts: np.ndarray) -> np.ndarray:
    """The nearest kept count below each count, as its place."""
    return (np.searchsorted(_KEPT_COUNTS, counts, side="right") - 1).astype(np.uint8)


def _coarse(edges: np.ndarray, none: int) -> np.ndarray:
    """The lower edges of every ``_FAN`` classes but the first, one row for each row of edges; ``none`` fills the row."""
    classes = edges.shape[1] - 1
    out = np.full((len(edges), _FAN), none, dtype=np.uint16)
    inner = edges[:, _FAN:classes:_FAN]
    out[:, :inner.shape[1]] = inner
    return out


def _fine(edges: np.ndarray, none: int) -> np.ndarray:
    """The lower edges within every ``_FAN`` classes but the first, one row for each of these runs."""
    classes = edges.shape[1] - 1
    fan = min(classes, _FAN)
    out = np.full((len(edges), classes // fan, _FAN), none, dtype=np.uint16)
    out[:, :, :fan - 1] = edges[:, :-1].reshape(len(edges), -1, fan)[:, :, 1:]
    return out.reshape(-1, _FAN)


def _packed(edges: np.ndarray) -> np.ndarray:
    """Each class's lower edge, and its width in the upper 16 bits: sums of packed numbers are packed sums."""
    return (edges[:, :-1] | np.diff(edges, axis=1) << 16).astype(np.uint32)


def _upto(edges: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many of a row's edges are at most the row's number."""
    found = np.bitwise_count((edges <= most).view(np.uint64))
    return (found[:, 0] + found[:, 1]).astype(np.int64)


class _Start:
    """What every block of a group starts from: the group's ids with their counts, the ids' classes
    (runs of ids of about equal weight) and how often a class follows another. Ids are ranks
    by their kept counts here, so that those of a class weigh about the same."""

    def __init__(self, names: np.ndarray, logs: np.ndarray, classes: int, follow: np.ndarray | None = None):
        self.stored, self.stored_logs, self.classes = names, logs, classes
        self.order = np.argsort(255 - logs, kind="stable")
        self.names = names[self.order]
        counts = np.maximum(_KEPT_COUNTS[logs[self.order]], 1)
        weight = counts  # an id weighs a class at most
        for _ in range(4):
            weight = np.minimum(counts, max(int(weight.sum()) // classes, 1))
        self.of = (np.cumsum(weight) - weight) * classes // int(weight.sum())
        members = np.bincount(self.of, minlength=classes)
        self.mass = np.bincount(self.of, weights=counts, minlength=classes).astype(np.int64)
        self.first = np.cumsum(members) - members
        self.many = np.maximum(members, 1)
        # One id's share of a class, a little less than the quotient: no product of it exceeds its class.
        self.each = (1 - 2.0 ** -40) / (self.many << 16 - _UP)
        self.even = np.cumsum(-(-members * _EVEN // len(names)))
        if follow is not None:
            self.follows(follow)

    def follows(self, logs: np.ndarray) -> None:
        """Edges of each class's row: seen pairs, eight more dealt as order 0 has them, some evenly."""
        self.follow = logs
        seen = _KEPT_COUNTS[logs].reshape(self.classes, self.classes)
        sums = np.cumsum(seen * int(self.mass.sum()) + 8 * self.mass, axis=1)
        self.edges = np.zeros((self.classes, self.classes + 1), dtype=np.int64)
        self.edges[:, 1:] = sums * (_STATIC - int(self.even[-1])) // sums[:, -1:] + self.even
        self.packed = _packed(self.edges).ravel()

    @classmethod
    def of_ids(cls, ids: np.ndarray, block: int) -> tuple[_Start, np.ndarray]:
        spans = [slice(at, at + _SPAN) for at in range(0, len(ids), _SPAN)]
        counts = np.zeros(1 << 16, dtype=np.int64)
        for some in spans:
            counts += np.bincount(ids[some], minlength=1 << 16)
        names = np.flatnonzero(counts)
        classes = 1
        while classes < _CLASSES and 64 * classes * classes <= len(ids):  # 16 ids for each pair of classes
            classes *= 2
        start = cls(names, _logs(counts[names]), classes)
        rank = np.zeros(1 << 16, dtype=np.uint16)
        rank[start.names] = np.arange(len(names))
        ranks, group = np.empty(len(ids), dtype=np.uint16), np.zeros(len(ids) + 1, dtype=np.uint8)
        of, follow = start.of.astype(np.uint8), np.zeros(classes * classes, dtype=np.int64)
        for some in spans:
            ranks[some] = rank.take(ids[some])
            group[1:][some] = of.take(ranks[some])
            pairs = group[:-1][some].astype(np.int64)
            pairs[-some.start % block::block] = 0
            pairs *= classes
            pairs += group[1:][some]
            follow += np.bincount(pairs, minlength=classes * classes)
        start.follows(_logs(follow))
        return start, ranks

    def pack(self) -> bytes:
        names = np.diff(self.stored, prepend=0).astype("<u2").tobytes()
        return zlib.compress(struct.pack("<II", len(self.stored), self.classes) + names + self.stored_logs.tobytes()
                             + self.follow.tobytes(), 6)

    @classmethod
    def unpack(cls, data: bytes) -> _Start:
        raw = zlib.decompress(data)
        count, classes = struct.unpack_from("<II", raw)
        names = np.cumsum(np.frombuffer(raw, dtype="<u2", count=count, offset=8).astype(np.int64))
        return cls(names, np.frombuffer(raw, dtype=np.uint8, count=count, offset=8 + 2 * count), classes,
                   np.frombuffer(raw, dtype=np.uint8, offset=8 + 3 * count))


class _Model:
    """The models of many blocks, one row each; a step works on the first ``n`` rows.

    A slot of a context holds its predicted rank times 8 plus the prediction's confidence."""

    def __init__(self, rows: int, start: _Start, steps: int, search: bool = False):
        lanes = np.arange(rows, dtype=np.int64)
        classes = start.classes
        self.classes, self.search = classes, search
        # The slots of order 1, then those of order 2; what is held of both stands in two rows.
        self.base = np.stack((lanes * _SLOTS1, rows * _SLOTS1 + lanes * _SLOTS2))
        self.base_own = lanes * classes
        self.slots = np.zeros(rows * (_SLOTS1 + _SLOTS2), np.int32)
        # Own counts start as the group's: about 32 of them, kept in 32nds.
        self.counts = np.zeros((rows, classes), dtype=np.int64) + (start.mass * 1024 // int(start.mass.sum()) + 1)
        self.own = np.zeros((rows, classes), dtype=np.uint32)  # packed edges
        self.seen = np.zeros((steps, rows), dtype=np.uint8)  # the classes of a block's ids, by step
        if search:
            fan = min(classes, _FAN)
            self.coarse = np.zeros((rows, _FAN), dtype=np.uint16)
            self.fine = np.zeros((rows, classes // fan, _FAN), dtype=np.uint16)
        self.last, self.before = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
        self.step, self.counted = 0, 0

    def refresh(self, n: int) -> None:
        """A block's own counts as edges."""
        classes = self.classes
        for at in range(0, n, _TOGETHER):
            some = slice(at, min(at + _TOGETHER, n))
            counts, seen = self.counts[some], self.seen[self.counted:self.step, some]
            if len(seen):
                cells = seen + np.arange(len(counts)) * classes
                counts += 32 * np.bincount(cells.ravel(), minlength=counts.size).reshape(counts.shape)
            sums = np.cumsum(counts, axis=1)
            edges = np.zeros((len(counts), classes + 1), dtype=np.int64)
            # A division and a product, each rounded once: the same on every machine.
            edges[:, 1:] = sums * ((_OWN - classes) / sums[:, -1:])
            edges[:, -1] = _OWN - classes
            edges += np.arange(classes + 1)
            self.own[some] = _packed(edges)
            if self.search:
                self.coarse[some] = _coarse(edges, 0)
                self.fine[some] = _fine(edges, 0).reshape(len(counts), -1, _FAN)
        self.counted = self.step

    def predict(self, n: int) -> None:
        if self.step % _REFRESH == 0 or self.step in _EARLY:
            self.refresh(n)
        self.at = np.empty((2, n), dtype=np.int64)
        mixed = np.multiply(self.last[:n], 40503, out=self.at[1])
        np.right_shift(mixed, 6, out=self.at[0])
        mixed += self.before[:n] * 30011
        mixed >>= 7
        self.at &= _MASKS
        self.at += self.base[:, :n]
        self.held = self.slots.take(self.at)
        self.p, self.sure = self.held >> 3, self.held & 7
        self.p1, self.p2 = self.p
        sure1, sure2 = self.sure
        both = (self.p1 == self.p2).astype(np.int32) << 3
        both |= sure2
        both <<= 3
        both |= sure1
        shares = _SHARES.take(both)
        self.m2, self.known = shares >> 17, shares & (1 << 17) - 1

    def update(self, ranks: np.ndarray, group: np.ndarray, hit: np.ndarray) -> None:
        """``hit``: where order 1's and order 2's predictions are the ids."""
        new = ranks.astype(np.int32)
        new <<= 3
        self.sure += hit.view(np.int8) << 3
        self.held += _GAIN.take(self.sure)
        self.slots[self.at.ravel()] = np.where(self.sure == 0, new, self.held).ravel()  # failed without confidence
        self.seen[self.step, :len(ranks)] = group
        self.step += 1
        self.before, self.last = self.last, ranks


def _grid(ids: np.ndarray, block: int, lengths: np.ndarray) -> np.ndarray:
    """Ids by (step, block)."""
    out = np.zeros(len(lengths) * block, dtype=ids.dtype)
    out[:len(ids)] = ids
    blocks = out.reshape(len(lengths), block)[:, :int(lengths.max())]
    grid = np.empty(blocks.T.shape, dtype=ids.dtype)
    for at in range(0, len(blocks), 64):
        grid[:, at:at + 64] = blocks[at:at + 64].T
    return grid


def encode(ids: np.ndarray, block: int = BLOCK, group: int = _GROUP) -> bytes:
    """The coded form of a run of ids below 65,536, ``group`` blocks at a time."""
    ids = np.asarray(ids)
    return b"".join(_encode_group(ids[at:at + block * group], block) for at in range(0, len(ids), block * group))


def _encode_group(ids: np.ndarray, block: int) -> bytes:
    begin, ranks = _Start.of_ids(ids, block)
    rows = -(-len(ids) // block)
    lengths = np.full(rows, block)
    lengths[-1] = len(ids) - (rows - 1) * block
    grid, of = _grid(ranks, block, lengths), begin.of.astype(np.uint8)
    steps = len(grid)
    model = _Model(rows, begin, steps)
    low, size = np.zeros(rows, dtype=np.int64), np.full(rows, _TOP, dtype=np.int64)
    place = np.arange(rows)  # of a block's next word
    words = np.zeros((steps + 4) * rows, dtype=np.int64)  # word-major: number * rows + block
    own = model.own.ravel()
    row = np.zeros(rows, dtype=np.int64)
    for t in range(steps):
        n = rows if t < lengths[-1] else rows - 1
        x = grid[t, :n].astype(np.int64)
        group = of.take(x).astype(np.int64)
        model.predict(n)
        hit = model.p == x
        hit1, hit2 = hit
        edges = own.take(model.base_own[:n] + group)
        edges += begin.packed.take(row[:n] + group)
        rest = _ONE - model.known
        start = (edges & 0xFFFF) * rest
        start >>= 16 - _UP
        edges >>= 16
        rest *= edges
        freq = (rest * begin.each.take(group)).astype(np.int64)
        start += freq * (x - begin.first.take(group))
        known = model.known << _UP
        start += known
        m2 = model.m2 << _UP
        known -= m2
        start = np.where(hit2, 0, np.where(hit1, m2, start))
        freq = np.where(hit2, m2, np.where(hit1, known, freq))
        step = size[:n] >> _FINE
        start *= step
        low[:n] += start
        np.multiply(step, freq, out=size[:n])
        # A word where the range has become short, with its carry: low and size stay below 2 ** 63 together.
        short = np.flatnonzero(size[:n] < _RANGE)
        kept, at = low.take(short), place.take(short)
        words[at] = kept >> 30
        place[short] = at + rows
        low[short] = (kept & _WORD) << 32
        size[short] = size.take(short) << 32
        model.update(x, group, hit)
        group *= begin.classes
        row = group
    for _ in range(2):  # the whole of low, as words
        words[place] = low >> 30
        low = (low & _WORD) << 32
        place += rows
    place //= rows
    table = words.reshape(-1, rows)[:int(place.max())]
    for j in range(len(table) - 1, 0, -1):
        table[j - 1] += table[j] >> 32
        table[j] &= 0xFFFFFFFF
    columns = np.ascontiguousarray(table.T.astype("<u4"))
    raw = ids.astype("<u4")
    packed = begin.pack()
    heads, bodies = [], []
    for b in range(rows):
        body = columns[b, :place[b]].tobytes().rstrip(b"\0")
        part = raw[b * block:b * block + int(lengths[b])]
        heads.append(struct.pack("<III", len(part), zlib.crc32(part.tobytes()), len(body)))
        bodies.append(body)
    head = MAGIC + struct.pack("<IIIII", block, rows, len(ids), len(packed), zlib.crc32(packed))
    return b"".join([head, packed, *heads, *bodies])


def decode(data: bytes) -> np.ndarray:
    """The ids of ``encode``'s result; a block or a start whose checksum differs is an error."""
    out, at = [np.zeros(0, dtype=np.uint32)], 0
    while at < len(data):
        ids, at = _decode_group(data, at)
        out.append(ids)
    return np.concatenate(out)


def _decode_group(data: bytes, at: int) -> tuple[np.ndarray, int]:
    if data[at:at + 4] != MAGIC:
        raise ValueError("not a token block")
    block, rows, total, n_start, check = struct.unpack_from("<IIIII", data, at + 4)
    at += 24
    packed = data[at:at + n_start]
    if zlib.crc32(packed) != check:
        raise ValueError("the start of a group is damaged")
    begin = _Start.unpack(packed)
    at += n_start
    facts = np.frombuffer(data, dtype="<u4", count=3 * rows, offset=at).reshape(rows, 3).astype(np.int64)
    lengths, sizes = facts[:, 0], facts[:, 2]
    steps = int(lengths.max())
    # A step reads one word at most; beyond the longest block's words there are zeros.
    columns = np.zeros((rows, min(int(sizes.max()) // 4 + 8, steps + 8)), dtype="<u4")
    at += 12 * rows
    for b in range(rows):
        body = data[at:at + int(sizes[b])]
        columns[b, :(len(body) + 3) // 4] = np.frombuffer(body + b"\0" * (-len(body) % 4), dtype="<u4")
        at += int(sizes[b])
    words = np.ascontiguousarray(columns.T).ravel()
    value = words[:rows].astype(np.int64) << 30 | words[rows:2 * rows].astype(np.int64) >> 2
    rest_bits = words[rows:2 * rows].astype(np.int64) & 3  # the window is 62 bits: two bits of word 1 wait
    place = np.arange(2 * rows, 3 * rows)  # of a block's next word
    size = np.full(rows, _TOP, dtype=np.int64)
    model = _Model(rows, begin, steps, search=True)
    own, classes = model.own.ravel(), begin.classes
    coarse, fine, fan = _coarse(begin.edges, _LAST + 1), _fine(begin.edges, _LAST + 1), min(classes, _FAN)
    runs, own_fine = classes // fan, model.fine.reshape(-1, _FAN)
    lanes, group = np.arange(rows) * runs, np.zeros(rows, dtype=np.int64)
    of, firsts = begin.of.astype(np.uint8), np.minimum(begin.first, len(begin.names) - 1)
    out = np.zeros((steps, rows), dtype=np.uint16)
    for t in range(steps):
        n = rows if t < lengths[-1] else rows - 1
        last = group[:n]
        model.predict(n)
        step = size[:n] >> _FINE
        goal = np.minimum(value[:n] // step, (1 << _FINE) - 1)
        known, m2 = model.known << _UP, model.m2 << _UP
        in2, in1 = goal < m2, goal < known
        # As if all had missed; a prediction's rank, start and size come over it. A damaged block must end
        # in its checksum, not out of bounds. Quotients of numbers far below 2 ** 53 come out exact as floats.
        rest, y = _ONE - model.known, np.maximum(goal - known, 0)
        most = y << 16 - _UP
        most |= (1 << 16 - _UP) - 1
        most = np.minimum(most / rest, _LAST).astype(np.uint16)[:, None]  # the class is the last whose edge is at most this
        guess, lane, row = 0, lanes[:n], last * runs
        if runs > 1:
            run = _upto(coarse.take(last, axis=0) + model.coarse[:n], most)
            guess, lane = run * fan, lane + run
            row += run
        found = fine.take(row, axis=0)
        found += own_fine.take(lane, axis=0)
        guess = _upto(found, most) + guess
        last = last * classes
        last += guess
        edges = own.take(model.base_own[:n] + guess)
        edges += begin.packed.take(last)
        lower = (edges & 0xFFFF) * rest
        lower >>= 16 - _UP
        edges >>= 16
        rest *= edges
        freq = (rest * begin.each.take(guess)).astype(np.int64)
        y -= lower
        inner = np.minimum((y / freq).astype(np.int64), begin.many.take(guess) - 1)
        lower += known
        lower += inner * freq
        inner += firsts.take(guess)
        known -= m2
        x = np.where(in2, model.p2, np.where(in1, model.p1, inner))
        start = np.where(in2, 0, np.where(in1, m2, lower))
        freq = np.where(in2, m2, np.where(in1, known, freq))
        start *= step
        value[:n] -= start
        np.multiply(step, freq, out=size[:n])
        short = np.flatnonzero(size[:n] < _RANGE)
        at_word = place.take(short)
        two = words.take(at_word, mode="clip").astype(np.int64)
        value[short] = value.take(short) << 32 | rest_bits.take(short) << 30 | two >> 2
        rest_bits[short] = two & 3
        place[short] = at_word + rows
        size[short] = size.take(short) << 32
        out[t, :n] = x
        group = of.take(x).astype(np.int64)
        model.update(x, group, model.p == x)
    ids = begin.names.astype(np.uint32)[np.ascontiguousarray(out.T).ravel()[:total]]
    for b in range(rows):
        if zlib.crc32(ids[b * block:b * block + int(lengths[b])].astype("<u4").tobytes()) != facts[b, 1]:
            raise ValueError(f"block {b} is damaged")
    return ids, at


class Words(dict):
    """White-space separated word -> its packed ids (little-endian unsigned 16-bit). Words of letters are kept.

    For tokenizers that compose (NFC), lower-case and drop white space, then split into
    contractions, letters, single digits and the rest: no token then spans white space."""

    #: The tokenizer's normalizer and split.
    NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: Separators for Python's split() that are not white space for the tokenizer.
    ODD = "\x1c\x1d\x1e\x1f"
    KEPT, LONGEST = 400_000, 64
    #: Code points of texts that are split together; a longer text is taken alone.
    TOGETHER = 1 << 23

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tool = Tokenizer.from_file(path)
        self.tool.no_padding()
        self.tool.no_truncation()
        self.tokenize = self.tool.model.tokenize
        self.packed = [struct.pack("<H", k) for k in range(1 << 16)]
        if self.tool.get_vocab_size() > 1 << 16:
            raise ValueError("more than 65,536 ids")
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        self.by_word = ((spec["normalizer"] or {}).get("normalizers") == self.NORMAL
                        and steps[0].get("pattern", {}).get("Regex") == self.SPLIT)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.split = regex.compile(self.SPLIT).findall
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the words kept before, of which those met again move over

    def _piece(self, piece: str) -> bytes:
        packed = self.pieces.get(piece)
        if packed is None:
            # Visible ASCII stands for itself.
            letters = (piece if piece.isascii() and piece.isprintable()
                       else piece.encode("utf-8").decode("latin-1").translate(_byte_letters()))
            packed = b"".join([self.packed[t.id] for t in self.tokenize(letters)])
            if len(piece) <= 4 and not piece.isalpha() and len(self.pieces) < 100_000:  # punctuation, digits, endings
                self.pieces[piece] = packed
        return packed

    def library(self, text: str) -> bytes:
        return np.array(self.tool.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def __missing__(self, word: str) -> bytes:
        if not word.isalpha():
            stem = word.rstrip(punctuation)
            if stem.isalpha():
                mark = word[len(stem):]
                return self[stem] + (self.pieces.get(mark) or self._piece(mark))
            return b"".join(self[p] if p.isalpha() else self._piece(p) for p in self.split(word))
        packed = self.older.get(word)
        if packed is None:
            # Words of letters are printable; visible ASCII stands for itself.
            packed = b"".join([self.packed[t.id] for t in self.tokenize(word)]) if word.isascii() else self._piece(word)
        if len(word) <= self.LONGEST:
            if len(self) >= self.KEPT:
                self.older = dict(self)
                self.clear()
            self[word] = packed
        return packed

    def plain(self, text: str) -> bool:
        """Whether the text may be taken word by word, if it has no code point unknown here."""
        normal = text.isascii() or ("Σ" not in text and unicodedata.is_normalized("NFC", text))
        return self.by_word and normal and not any(s in text for s in self.specials) and not any(c in text for c in self.ODD)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str], end: bytes = b"") -> list[bytes]:
        """The packed ids of each text, each followed by ``end``. Each distinct word of a run of texts is looked up once."""
        out: list[bytes] = []
        for some in batches(texts, self.TOGETHER):
            plain = [self.plain(t) for t in some]
            lists, coded, once = _distinct(some, plain)
            if not once.isascii() and _unknown(once):
                plain = [p and not _unknown(t) for t, p in zip(some, plain)]
                lists, coded, once = _distinct(some, plain)
            packed = list(map(self.__getitem__, once.split("\n")))
            sizes = np.array([len(x) // 2 for x in packed], dtype=np.int64)
            held, firsts = np.frombuffer(b"".join(packed), dtype="<u2"), np.cumsum(sizes) - sizes
            word = coded.indices.to_numpy()
            size = sizes.take(word)
            ends = np.cumsum(size)
            at = np.repeat(firsts.take(word) - (ends - size), size)
            at += np.arange(len(at))
            ids = held.take(at).tobytes()
            edges = np.concatenate(([0], ends))[lists.offsets.to_numpy()] * 2
            out += [(ids[a:b] if p else self.library(t)) + end for t, p, a, b in zip(some, plain, edges.tolist(), edges[1:].tolist())]
        return out


def _distinct(texts: list[str], plain: list[bool]) -> tuple[pa.Array, pa.Array, str]:
    """The words of the plain texts as lists, all of them as a dictionary array, and the distinct ones, a line each."""
    lists = pc.utf8_split_whitespace(pa.array([t.lower() if p else "" for t, p in zip(texts, plain)], pa.large_string()))
    coded = lists.values.dictionary_encode()
    once = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary.cast(pa.string()))
    return lists, coded, pc.binary_join(once, "\n")[0].as_py()


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


def packed_ids(text: Column, path: str, end_id: int | None) -> Column:
    """The ids of a text and the end id, little-endian unsigned 16-bit."""
    end = b"" if end_id is None else struct.pack("<H", end_id)

    @F.pandas_udf("binary")
    def one(texts: pd.Series) -> pd.Series:
        return pd.Series(words(path).encode_all([t or "" for t in texts], end), dtype=object)

    return one(text)


def _chunks(block: int, chunk: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words.cache_clear()  # of a worker that tokenised before
        ids: list = []
        held: list[bytes] = []
        size = number = before = 0
        part = -1

        def row() -> pd.DataFrame:
            run_ids = np.frombuffer(b"".join(held), dtype="<u2")
            return pd.DataFrame({
                "part": [part], "chunk": [number], "before": [before], "n_docs": [len(ids)], "n_tokens": [len(run_ids)],
                "doc_ids": [np.array([0 if x is None else x for x in ids], dtype="<i8").tobytes()],
                "no_id": [np.array([x is None for x in ids], dtype=np.uint8).tobytes()],
                "lengths": [np.array([len(x) // 2 for x in held], dtype="<i8").tobytes()],
                "blocks": [encode(run_ids, block)]})

        for frame in parts:
            for p, id, packed in zip(frame["part"], frame["id"], frame["ids"]):
                part = p
                ids.append(None if pd.isna(id) else int(id))
                held.append(packed)
                size += len(packed) // 2
                if size >= chunk:
                    yield row()
                    ids, held, size, number, before = [], [], 0, number + 1, before + size
        if ids:
            yield row()

    return run


FILE_SCHEMA = ("part int, chunk int, before long, n_docs long, n_tokens long, doc_ids binary, no_id binary, lengths binary, "
               "blocks binary")


def write_token_files(docs: DataFrame, path: str, text: str = "text", id: str = "doc_id", end_id: int | None = None,
                      block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """Writes the token files of ``docs`` below the shared work folder and returns them as read back."""
    small_batches(docs.sparkSession)
    coded = stage(docs.select(q(id).cast("long").alias("id"), packed_ids(q(text), path, end_id).alias("ids")), "token-ids")
    ordered = (coded.repartitionByRange(partitions(docs.sparkSession), F.col("id").asc_nulls_first())
               .sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("ids")))
    files = ordered.select(F.spark_partition_id().alias("part"), "id", "ids").mapInPandas(_chunks(block, chunk), FILE_SCHEMA)
    return stage(files, "token-files")


def _documents(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in parts:
        for row in frame.itertuples():
            ids = decode(row.blocks).astype("<u4")
            lengths = np.frombuffer(row.lengths, dtype="<i8")
            ends = np.cumsum(lengths)
            starts = ends - lengths
            names = pd.array(np.frombuffer(row.doc_ids, dtype="<i8"), dtype="Int64")
            names[np.frombuffer(row.no_id, dtype=np.uint8) > 0] = pd.NA
            for at in range(0, len(lengths), 4096):
                some = slice(at, at + 4096)
                yield pd.DataFrame({
                    "part": row.part, "doc_id": names[some], "place": starts[some] + row.before,
                    "ids": [ids[a:b].tobytes() for a, b in zip(starts[some], ends[some])]})


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document: ``ids`` little-endian unsigned 32-bit, ``start`` the
    number of ids before it in all files."""
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    first = parts.select(F.col("part").alias("f_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("f"))
    held = files.select("part", "before", "doc_ids", "no_id", "lengths", "blocks").mapInPandas(
        _documents, "part int, doc_id long, place long, ids binary")
    # One row for each range of ids that was written: as many as there were shuffle partitions.
    return (held.join(F.broadcast(first), F.col("part") == F.col("f_part"))
            .select("doc_id", (F.col("f") + F.col("place")).alias("start"), "ids"))
