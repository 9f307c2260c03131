"""Pre-tokenisation without regular expressions: class arrays and associative scans.

The splitting rule of byte-level tokenizers is a small automaton over classes
of code points. Each class is a function from state to state, and the functions
that arise by composing them form a finite table. Because composition is
associative, the class array is cut into lanes whose functions are composed
side by side, lanes are chained by applying their total function, and each lane
then runs from its own entry state and marks where pieces begin.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

# Classes of code points.
END, LETTER, NUMBER, SPACE, WHITE, APOSTROPHE, STMD, R, V, L, E, OTHER = range(12)
#: White space beside U+0020 (Unicode White_Space).
WHITE_POINTS = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_CLASSES = 12
_LANES = 1024
#: Code points cut together; a longer text is taken alone.
TOGETHER = 1 << 20


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    kind = np.full(0x110000 + 1, OTHER, dtype=np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major == "L":
            kind[c] = LETTER
        elif major == "N":
            kind[c] = NUMBER
    kind[WHITE_POINTS] = WHITE
    for chars, k in ((" ", SPACE), ("'", APOSTROPHE), ("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E)):
        kind[[ord(c) for c in chars]] = k
    kind[0x110000] = END
    return kind


# States: what the text read so far decides about the next character.
_START, _IN_L, _IN_N, _IN_O, _W1S, _W1, _WKS, _WK, _AP, _AP_R, _AP_V, _AP_L, _DONE = range(13)
_STATES = 13


def _step(state: int, kind: int) -> tuple[int, int, int]:
    """(next state, a piece begins here, a piece begins one before)."""
    late = 0
    if state in (_AP_R, _AP_V, _AP_L):
        if (state, kind) in ((_AP_R, E), (_AP_V, E), (_AP_L, L)):
            return _DONE, 0, 0
        state, late = _IN_L, 1  # no contraction: the apostrophe stands alone and letters began one before
    if kind == END:
        return _START, 1, late
    blank = state in (_W1S, _W1, _WKS, _WK)
    if kind in (SPACE, WHITE):
        if blank:
            return (_WKS if kind == SPACE else _WK), 0, 0
        return (_W1S if kind == SPACE else _W1), 1, late
    attached = state in (_W1S, _WKS)  # the last blank is a space and leads this piece
    if state in (_WKS, _WK):
        late = 1
    if kind == NUMBER:
        return _IN_N, int(not attached and state != _IN_N), late
    if kind in (OTHER, APOSTROPHE):
        joined = attached or state in (_IN_O, _AP)
        if kind == APOSTROPHE and not joined:
            return _AP, 1, late
        return _IN_O, int(not joined), late
    if state == _AP:
        follow = {STMD: _DONE, R: _AP_R, V: _AP_V, L: _AP_L}.get(kind)
        return (_IN_L, 1, 0) if follow is None else (follow, 0, 0)
    return _IN_L, int(not attached and state != _IN_L), late


#: Rows of the flat tables are this long; functions and states are kept multiplied by it.
_ROW = 16


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat tables: (function, class) -> function, function -> its state by state,
    (state, class) -> state, and (state, class) -> 1 if a piece begins here, 2 if one before."""
    steps = [[_step(s, c) for c in range(_CLASSES)] for s in range(_STATES)]
    known = {tuple(range(_STATES)): 0}
    queue = [tuple(range(_STATES))]
    compose: list[int] = []
    for f in queue:  # grows while new functions arise
        for c in range(_CLASSES):
            g = tuple(steps[s][c][0] for s in f)
            if g not in known:
                known[g] = len(queue)
                queue.append(g)
            compose.append(known[g] * _ROW)
        compose += [0] * (_ROW - _CLASSES)
    pad = [(0, 0, 0)] * (_ROW - _CLASSES)
    flat = [x for row in steps for x in row + pad]
    return (np.array(compose, dtype=np.intp), np.array(queue, dtype=np.intp),
            np.array([x[0] * _ROW for x in flat], dtype=np.intp),
            np.array([x[1] + 2 * x[2] for x in flat], dtype=np.uint8))


def boundaries(kinds: np.ndarray) -> np.ndarray:
    """True where a piece begins, for a class array that ends with END."""
    compose, apply, move, emit = automaton()
    n = len(kinds)
    lanes = max(1, min(_LANES, n // 64))
    steps = -(-n // lanes)
    grid = np.full(lanes * steps, END, dtype=np.uint8)
    grid[:n] = kinds
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    total, at = np.zeros(lanes, dtype=np.intp), np.empty(lanes, dtype=np.intp)
    for t in range(steps):  # each lane's composed function
        np.add(total, grid[t], out=at)
        np.take(compose, at, out=total, mode="clip")
    state, entry = _START, np.empty(lanes, dtype=np.intp)
    for lane, f in enumerate((total // _ROW).tolist()):
        entry[lane] = state * _ROW
        state = int(apply[f, state])
    out = np.empty((steps, lanes), dtype=np.uint8)
    for t in range(steps):
        np.add(entry, grid[t], out=at)
        np.take(emit, at, out=out[t], mode="clip")
        np.take(move, at, out=entry, mode="clip")
    marks = out.T.ravel()[:n]
    begins = (marks & 1).astype(bool)
    begins[:-1] |= marks[1:] > 1
    return begins


def batches(texts: list[str], together: int = TOGETHER) -> Iterator[list[str]]:
    """Consecutive texts of up to ``together`` code points in all."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= together):
            size += len(texts[upto])
            upto += 1
        yield texts[at:upto]
        at = upto


def cut(texts: list[str], as_bytes: bool) -> list[list]:
    """The pieces of each text, as strings or as UTF-8 bytes."""
    data = [t.encode("utf-8") for t in texts] if as_bytes else texts
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    chars = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(chars) + np.arange(len(texts))  # each text is closed by an END
    kinds = np.insert(classes()[points], ends - np.arange(len(texts)), END)
    begins = np.flatnonzero(boundaries(kinds))
    of = np.searchsorted(ends, begins)
    starts = begins - of  # places in the joined text, without the ENDs
    if as_bytes:
        width = np.empty(len(points) + 1, dtype=np.int64)
        width[0] = 0
        np.cumsum(1 + (points >= 0x80).view(np.uint8) + (points >= 0x800).view(np.uint8)
                  + (points >= 0x10000).view(np.uint8), out=width[1:])
        starts = width[starts]
    edge = np.searchsorted(of, np.arange(len(texts) + 1))
    shift, out = 0, []
    for k, text in enumerate(data):
        places = (starts[edge[k]:edge[k + 1]] - shift).tolist()  # the last is the text's END
        out.append([text[a:b] for a, b in zip(places, places[1:])])
        shift += len(text)
    return out
