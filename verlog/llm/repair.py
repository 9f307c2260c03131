"""Conversation structure repair: the cheapest edits that give a well-formed order of roles, as an audit.

Well-formed are the role initials ``(s?(ua)+)?``. Each row is kept (K), given the
role user or assistant (R), or deleted (D); empty turns can be inserted (I).
A row's fault is the first of blank, duplicate (role and text seen earlier in the
conversation), truncated (its last character that is not white space ends no
sentence). The prices are in ``Prices``.

Faults come from DataFrame expressions and one window over equal rows. Then a
conversation's rows stream in order through a dynamic program over the four states
of the pattern. A state's best edits are a linked node; edits that several states
share are the same nodes. Each node has its ancestors at distances 1, 2, 4, ... and
a rolling hash of all letters up to it, so two audits of equal cost are
ordered by a search for their longest common prefix in logarithmic steps; the
prefix found is verified on the nodes themselves, and on a collision the letters
decide. (Of equal cost and over the same rows no audit is a prefix of another: letters
beyond it could only be inserts, and they cost. So the order of two audits is the
order of all that continue them, and the least one of each state is enough.)

A state that another one beats whatever follows is dropped. Whenever the
remaining states' edits share their beginning, those edits are final: they are
emitted and their rows let go. A task so holds a conversation's undecided rows, not
the conversation; its digest is a running one, as SHA-256 allows no other.

Null role or text counts as one space. Rows go by turn (null first), equal turns by
role and text; of repeated rows all but the first are duplicates. A null
conversation id is one conversation. Conversations without rows (all of theirs
``gone``) keep one row without edit. An empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.llm.common import q
from verlog.llm.turns import in_order, streamed

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
_WHITE = " \t\n\x0b\x0c\r"

#: Rows that wait before their common edits are looked for.
WAIT = 64


@dataclass(frozen=True)
class Prices:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5  # for a truncated row that stays


# States: nothing so far, after system, after user, after assistant; the first and the last may end.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_NEXT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}

_MOD, _BASE = (1 << 61) - 1, 911382323


class Node:
    """A letter after the edits of ``up[0]``; ``up[k]`` is the ancestor 2**k letters before."""

    __slots__ = ("cost", "depth", "hash", "letter", "role", "up")

    def __init__(self, before: Node | None, letter: str = "", cost: int = 0, role: str | None = None):
        self.letter, self.cost, self.role, self.up = letter, cost, role, []
        self.depth = self.hash = 0
        if before is not None:
            self.depth = before.depth + 1
            self.hash = (before.hash * _BASE + ord(letter)) % _MOD
            while before is not None:
                self.up.append(before)
                k = len(self.up) - 1
                before = before.up[k] if k < len(before.up) else None

    def back(self, depth: int) -> Node:
        """The ancestor at ``depth``."""
        node, rest = self, self.depth - depth
        while rest:
            k = rest.bit_length() - 1
            node, rest = node.up[k], rest - (1 << k)
        return node

    def since(self, ancestor: Node) -> list[Node]:
        """The nodes after ``ancestor`` up to this one."""
        out, node = [], self
        while node is not ancestor:
            out.append(node)
            node = node.up[0]
        return out[::-1]


def _equal(a: Node, b: Node) -> bool:
    """Whether two nodes of equal depth spell the same letters."""
    while a is not b:
        if a.letter != b.letter:
            return False
        if not a.up:
            break
        a, b = a.up[0], b.up[0]
    return True


def _spelt(node: Node) -> str:
    return "".join(n.letter for n in node.since(node.back(0)))


def less(a: Node, b: Node) -> bool:
    """Whether the letters of ``a`` come before those of ``b``."""
    depth = min(a.depth, b.depth)
    x, y = a.back(depth), b.back(depth)
    if x.hash == y.hash:
        return a.depth < b.depth if _equal(x, y) else _spelt(a) < _spelt(b)
    for k in reversed(range(len(x.up))):
        if k < len(x.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    # Now the letters differ and what stands before them has equal hashes.
    return x.letter < y.letter if _equal(x.up[0], y.up[0]) else _spelt(a) < _spelt(b)


def _better(a: Node, b: Node | None) -> bool:
    if b is None or a.cost != b.cost:
        return b is None or a.cost < b.cost
    return a is not b and less(a, b)


def _step(best: dict[int, Node], initial: str, fault: str | None, prices: Prices) -> dict[int, Node]:
    """The best edits of every state after one more row."""
    out: dict[int, Node] = {}

    def offer(state: int, before: Node, letter: str, cost: int, role: str | None = None) -> None:
        if state in out and before.cost + cost > out[state].cost:
            return
        node = Node(before, letter, before.cost + cost, role)
        if _better(node, out.get(state)):
            out[state] = node

    stays = prices.truncated if fault == TRUNCATED else 0
    for state, before in best.items():
        offer(state, before, "D", prices.delete)
        if fault in (BLANK, DUPLICATE):
            continue
        if (state, initial) in _NEXT:
            offer(_NEXT[state, initial], before, "K", stays)
        to = ASSISTANT if state == USER else USER
        offer(to, before, "R", prices.rerole + stays, _NAMES[to])
    return _inserted(out, prices)


def _inserted(best: dict[int, Node], prices: Prices) -> dict[int, Node]:
    """States reached by inserting empty turns, a user and then an assistant."""
    out = dict(best)
    for state in (NOTHING, SYSTEM, ASSISTANT):
        if state in best:
            node = Node(best[state], "I", best[state].cost + prices.insert, _NAMES[USER])
            if _better(node, out.get(USER)):
                out[USER] = node
    if USER in out:
        node = Node(out[USER], "I", out[USER].cost + prices.insert, _NAMES[ASSISTANT])
        if _better(node, out.get(ASSISTANT)):
            out[ASSISTANT] = node
    return _undominated(out, prices)


def _undominated(best: dict[int, Node], prices: Prices) -> dict[int, Node]:
    """Without the states that some other state beats whatever follows, by what it costs at most to do as they would."""
    one, two, drop = prices.insert, 2 * prices.insert, prices.delete
    more = {(NOTHING, SYSTEM): 0, (NOTHING, USER): one, (NOTHING, ASSISTANT): 0,
            (SYSTEM, NOTHING): two + drop, (SYSTEM, USER): one, (SYSTEM, ASSISTANT): two,
            (USER, NOTHING): one + drop, (USER, SYSTEM): one, (USER, ASSISTANT): one,
            (ASSISTANT, NOTHING): drop, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): one}
    return {t: n for t, n in best.items()
            if not any(s != t and o.cost + more[s, t] < n.cost for s, o in best.items())}


def _common(nodes: list[Node]) -> Node:
    """The last node that all of ``nodes`` go through."""
    first = nodes[0]
    for other in nodes[1:]:
        depth = min(first.depth, other.depth)
        x, y = first.back(depth), other.back(depth)
        if x is not y:
            for k in reversed(range(len(x.up))):
                if k < len(x.up) and x.up[k] is not y.up[k]:
                    x, y = x.up[k], y.up[k]
            x = x.up[0]
        first = x
    return first


def _replanted(best: dict[int, Node], root: Node) -> tuple[dict[int, Node], Node]:
    """The same edits after ``root``, on nodes that hold nothing of what lies before it."""
    fresh = Node(None, cost=root.cost)
    made = {id(root): fresh}
    for node in best.values():
        for n in node.since(root):
            if id(n) not in made:
                made[id(n)] = Node(made[id(n.up[0])], n.letter, n.cost, n.role)
    return {s: made[id(n)] for s, n in best.items()}, fresh


def audited(rows: Iterable[tuple], prices: Prices) -> Iterator[tuple]:
    """Edits of one conversation in order, from its rows (turn, role, text, fault): (edit, cost, fault, turn,
    role before, role, text)."""
    root = Node(None)
    best = _inserted({NOTHING: root}, prices)
    waiting: deque[tuple] = deque()

    def decided(upto: Node) -> Iterator[tuple]:
        spent = root.cost
        for node in upto.since(root):
            if node.letter == "I":
                yield "I", node.cost - spent, None, None, None, node.role, ""
            else:
                turn, role, text, fault = waiting.popleft()
                now, stays = (None, None) if node.letter == "D" else (node.role or role, text)
                yield node.letter, node.cost - spent, fault, turn, role, now, stays
            spent = node.cost

    look = WAIT
    for row in rows:
        waiting.append(row)
        best = _step(best, row[1][:1], row[3], prices)
        if len(waiting) >= look:
            upto = _common(list(best.values()))
            yield from decided(upto)
            best, root = _replanted(best, upto)
            look = max(WAIT, 2 * len(waiting))
    ends = [best[s] for s in (NOTHING, ASSISTANT) if s in best]
    last = ends[0] if len(ends) == 1 or _better(ends[0], ends[1]) else ends[1]
    yield from decided(last)


def repair(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           gone: Column | None = None, prices: Prices = Prices()) -> DataFrame:
    """The audit of every conversation, one row an edit: id, ``seq``, ``edit`` (K, R, D, I), ``cost``, ``fault``, ``turn``
    and ``was_role`` of the row, ``role`` and ``text`` after the edit (null if deleted). The rows with a role are, by
    ``seq``, the repaired conversation. ``gone`` marks rows that are not there."""
    given = rows.select(q(conversation).alias("_c"), q(turn).cast("long").alias("_t"),
                        F.coalesce(q(role), F.lit(" ")).alias("_r"), F.coalesce(q(text), F.lit(" ")).alias("_x"),
                        F.coalesce(gone if gone is not None else F.lit(False), F.lit(False)).alias("_gone"))
    equal = Window.partitionBy("_c", "_r", "_x", "_gone").orderBy(F.col("_t").asc_nulls_first())
    last = F.substring(F.rtrim(F.col("_x"), F.lit(_WHITE)), -1, 1)
    fault = (F.when(last == "", BLANK).when(F.col("_k") > 1, DUPLICATE).when(~last.isin(".", "!", "?"), TRUNCATED))
    faulty = given.withColumn("_k", F.row_number().over(equal)).withColumn("_fault", fault)
    ordered = in_order(faulty, "_c", [F.col("_t").asc_nulls_first(), F.col("_r"), F.col("_x"), F.col("_k")])

    def edits(turns: Iterator[tuple]) -> Iterator[tuple]:
        for key, own in groupby(turns, key=itemgetter(0)):
            there = (t[1:4] + (t[6],) for t in own if not t[4])
            seq = -1
            for seq, edit in enumerate(audited(there, prices)):
                yield key, seq, *edit
            if seq < 0:
                yield key, 0, None, 0, None, None, None, None, None

    whole, word = T.LongType(), T.StringType()
    return streamed(ordered, edits, T.StructType([
        T.StructField("_c", given.schema["_c"].dataType), T.StructField("seq", whole), T.StructField("edit", word),
        T.StructField("cost", whole), T.StructField("fault", word), T.StructField("turn", whole),
        T.StructField("was_role", word), T.StructField("role", word), T.StructField("text", word)]), text=8) \
        .withColumnRenamed("_c", conversation)


def audits(edits: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """What ``repair`` did, one row a conversation: gaps in its turn numbers, rows by fault, adjacent roles out of
    order, total cost, the edits' letters, and the digest of the repaired turns.

    Takes the edits as they come from ``repair``, a conversation's side by side and in order."""
    given = edits.select(q(conversation), "edit", "cost", "fault", "turn", "was_role", "role", "text")

    def summed(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, own in groupby(rows, key=itemgetter(0)):
            faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
            digest, letters = hashlib.sha256(), []
            first = turn_before = role_before = None
            distinct = illegal = cost = begun = 0
            for _, edit, price, fault, turn, was, role, text in own:
                if edit is None:
                    continue
                letters.append(edit)
                cost += price
                if fault:
                    faults[fault] += 1
                if turn is not None and turn != turn_before:  # in order, nulls first
                    first = turn if first is None else first
                    distinct, turn_before = distinct + 1, turn
                if edit != "I":
                    illegal += role_before is not None and role_before + was[:1] not in ("su", "ua", "au")
                    role_before = was[:1]
                if role is not None:
                    digest.update((("\n" if begun else "") + f"{role}:{text}").encode())
                    begun = 1
            gaps = turn_before - first + 1 - distinct if distinct else 0
            yield (key, gaps, *faults.values(), illegal, cost, "".join(letters), digest.hexdigest())

    whole, word = T.LongType(), T.StringType()
    return streamed(given, summed, T.StructType([
        given.schema.fields[0], *[T.StructField(c, whole) for c in ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost")],
        T.StructField("audit", word), T.StructField("repaired_sha256", word)]))
