"""Token counts by a two-tier lookup that never shuffles pre-tokens.

The first tier is a table of frequent pre-tokens and their token counts,
broadcast once; the second is each worker's cache, which the tokenizer library
fills for pre-tokens that the table misses. A text's count is the sum over its
pre-tokens. The table only saves work: whatever it holds, counts are the
library's.

The table is bounded to ``TABLE`` pre-tokens, found over all rows without an
exchange: a task counts what stands between single spaces, cuts each distinct such
string once, and writes one list of at most ``TABLE`` candidates with their counts.
Lists are merged ``FAN`` at a time by tasks that read several files, each result
bounded again, until one list is left; only that reaches the driver.

Texts are cut by ``pretokens`` (class arrays and scans). Its character classes
are the library's for every code point that this Python's Unicode tables know;
a text with a code point unknown to them goes to the library whole. Strings of
added tokens inside a text count as the library counts them: the text is split
at them.

Nulls and odd rows: a null text counts as empty (0 bytes, 0 tokens); repeated
rows and null ids pass through; very long texts are counted whole; an empty
table gives an empty result; an input column named like a result column gives
way to it.
"""

from __future__ import annotations

import json
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verlog.llm.common import others, q, small_batches, stage
from verlog.llm.pretokens import batches, cut

#: Pre-tokens in the broadcast table, and the share of rows they are looked for in.
TABLE, SHARE = 32_768, 1.0
#: Lists of candidates that one task merges.
FAN = 32
_CACHE = 250_000
_MARKS = tuple(".,;:!?")
_HELD = 1 << 23  # code points of distinct strings between spaces that a task holds before it cuts them
_LONGEST = 64  # characters of a pre-token that is worth keeping


class _Counts(dict):
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex"):
            raise ValueError("token counts need a plain byte-level tokenizer")
        self.tool = Tokenizer.from_file(path)
        self.tool.no_padding()
        self.tool.no_truncation()
        special = [t["content"] for t in spec["added_tokens"]]
        plain = not any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized"))
        self.special = special[0] if len(special) == 1 and plain else None
        self.specials = special

    def library(self, text: str) -> int:
        return len(self.tool.encode(text, add_special_tokens=False))

    frequent: dict[str, int] = {}

    def refill(self) -> None:
        self.clear()
        self.update(self.frequent)

    def __missing__(self, piece: str) -> int:  # too long to keep
        return self.library(piece)

    def learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self and len(p) <= _LONGEST]
        if len(self) + len(new) > _CACHE + len(self.frequent):
            self.refill()
            new = [p for p in pieces if p not in self and len(p) <= _LONGEST]
        tokenize, letters = self.tool.model.tokenize, _byte_letters()
        self.update((p, len(tokenize(p.encode("utf-8").decode("latin-1").translate(letters)))) for p in new)

    def count_all(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        parts, of = [], []
        for i, text in enumerate(texts):
            special = [s for s in self.specials if s in text]
            if special and self.special is None or text and not text.isascii() and _unknown(text):
                out[i] = self.library(text)
                continue
            for k, part in enumerate(text.split(self.special) if special else [text]):
                out[i] += k > 0
                if part:
                    parts.append(part)
                    of.append(i)
        at = 0
        for some in batches(parts):
            cuts = cut(some, as_bytes=False)
            self.learn(set().union(*cuts))
            for k, pieces in enumerate(cuts):
                out[of[at + k]] += sum(map(self.__getitem__, pieces))
            at += len(some)
        return out


@lru_cache(maxsize=1)
def _byte_letters() -> dict[int, str]:
    """The visible letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 bytes stand for themselves, the others are numbered from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(0x100 + k) for k, b in enumerate(rest)}


@lru_cache(maxsize=1)
def _unassigned() -> np.ndarray:
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


def _unknown(text: str) -> bool:
    return bool(_unassigned()[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")].any())


@lru_cache(maxsize=2)
def counts(path: str) -> _Counts:
    return _Counts(path)


LISTS = "pieces array<string>, counts array<long>"


def _pruned(counter: Counter, bound: int) -> Counter:
    return Counter(dict(counter.most_common(4 * bound))) if len(counter) > 8 * bound else counter


def _list(counter: Counter, bound: int) -> pd.DataFrame:
    kept = counter.most_common(bound)
    return pd.DataFrame({"pieces": [[p for p, _ in kept]], "counts": [[n for _, n in kept]]})


def _candidates(bound: int):
    """One list for each partition of texts."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        begins: Counter = Counter()  # what a text begins with, up to its first space
        spaced: Counter = Counter()  # what follows a space, up to the next one

        def cut_all() -> None:
            nonlocal found
            for strings, lead in ((begins, ""), (spaced, " ")):
                odd = []
                for s, n in strings.items():
                    # Letters are one pre-token, and a mark behind them is one of its own.
                    stem = s[:-1] if s[-1:] in _MARKS else s
                    if not stem.isalpha():
                        odd.append(lead + s)
                        continue
                    if len(stem) < _LONGEST:
                        found[lead + stem] += n
                    if stem is not s:
                        found[s[-1]] += n
                for some in batches(odd):
                    for string, pieces in zip(some, cut(some, as_bytes=False)):
                        n = strings[string[len(lead):]]
                        for p in pieces:
                            if len(p) <= _LONGEST:
                                found[p] += n
                strings.clear()
            found = _pruned(found, bound)

        held = 0
        for frame in parts:
            for text in frame["text"]:
                first, *rest = text.split(" ")
                before = len(spaced) + len(begins)
                begins[first] += 1
                spaced.update(rest)
                # A string that is new is about as long as a word, but in a text with few spaces.
                held += len(text) if len(text) > 64 * (len(rest) + 1) else 16 * (len(spaced) + len(begins) - before)
                if held > _HELD:
                    cut_all()
                    held = 0
        cut_all()
        if found:
            yield _list(found, bound)

    return run


def _merged(bound: int):
    """One list for each partition of lists."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for frame in parts:
            for pieces, counts in zip(frame["pieces"], frame["counts"]):
                for p, n in zip(pieces, counts):
                    found[p] += int(n)
                found = _pruned(found, bound)
        if found:
            yield _list(found, bound)

    return run


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", table: int = TABLE,
                     share: float = SHARE) -> dict[str, int]:
    """At most ``table`` frequent pre-tokens and their token counts."""
    small_batches(docs.sparkSession)
    rows = docs.select(q(text).alias("text")).where(q(text).isNotNull())
    rows = rows if share >= 1 else rows.sample(share, seed=7)
    lists = stage(rows.mapInPandas(_candidates(max(table, TABLE)), LISTS), "pre-token-lists")
    while (n := lists.count()) > 1:
        lists = stage(lists.coalesce(-(-n // FAN)).mapInPandas(_merged(max(table, TABLE)), LISTS), "pre-token-lists")
    last = lists.select(F.slice("pieces", 1, table).alias("pieces")).first()
    tool = counts(path)
    return {piece: tool.library(piece) for piece in (last["pieces"] if last else [])}


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 1024, table: int = TABLE,
                 share: float = SHARE) -> DataFrame:
    """Every row of ``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    held = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text, table, share))
    new = ["n_bytes", "n_tokens", "over_limit"]

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        tool = counts(path)
        if tool.frequent is not held.value:
            tool.frequent = held.value
            tool.refill()
        return pd.Series(tool.count_all([t or "" for t in texts]), dtype="int64")

    kept = others(docs, new)
    counted = docs.select(*[q(c) for c in kept],
                          F.octet_length(F.coalesce(q(text), F.lit(""))).cast("long").alias("n_bytes"),
                          n_tokens(q(text)).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
