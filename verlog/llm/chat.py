"""Chat formatting with a grammar round trip.

Template, and the grammar of the deterministic parser::

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>\\n"

A control string is ``<|im_start|>``, ``<|im_end|>`` or ``<|nl|>`` (a line break
inside a role). Escaping puts one backslash more after the ``<`` of every control
string, escaped ones included, and the parser takes one away, so any text comes
back. Each turn is rendered as it is, parsed again and compared with its source; only
where the two differ its text, its role, or both are escaped, until they are identical.
A turn's rendering is then read whole by the parser and leaves it where it began, so
that what holds for each turn holds for their concatenation.

The form that a turn needs is found wherever the turn lies. Then a conversation's turns stream in order
through one task, which holds one part of at most ``PART`` code points (or one
longer turn): a usual conversation is one row, a very long one goes on in further
parts, cut between turns. Reading back streams the parts in the same way: digests
are running ones, as SHA-256 allows no other, so a conversation with a third of all
rows takes one task's time but not its memory.

Null text or role counts as empty. Turns go by number (null first), equal numbers by
role and text; repeated rows are turns of their own. A null conversation id is one
conversation. An empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from contextlib import suppress
from itertools import groupby
from operator import itemgetter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verlog.llm.common import q
from verlog.llm.turns import in_order, streamed

# The control strings of the template.
START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
_CONTROL = re.compile(r"<(\\*)(\|(?:im_start|im_end|nl)\|>)")
_ESCAPED = re.compile(r"<\\(\\*)(\|(?:im_start|im_end|nl)\|>)")

#: Code points of a part, unless one turn is longer.
PART = 1 << 20
#: The role whose texts are under the loss mask.
LEARNT = "assistant"


class NotInGrammar(ValueError):
    pass


def escaped(text: str) -> str:
    return _CONTROL.sub(r"<\\\1\2", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1\2", text)


def _escaped_role(role: str) -> str:
    return escaped(role).replace("\n", BREAK)


def _role(rendered: str) -> str:
    return unescaped(rendered.replace(BREAK, "\n"))


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """The turns of a rendered conversation: role, text, and where the (escaped) text starts and ends."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise NotInGrammar(f"no turn at {at}")
        line = rendered.find("\n", at)
        start = line + 1
        end = rendered.find(END + "\n", start) if line >= 0 else -1
        if end < 0 or START in (body := rendered[start:end]) or END in body:
            raise NotInGrammar(f"turn at {at} does not end")
        if START in (name := rendered[at + len(START):line]) or END in name:
            raise NotInGrammar(f"a control string in the role at {at}")
        turns.append((_role(name), unescaped(body), start, end))
        at = end + len(END) + 1
    return turns


def _written(role: str, text: str, form: int) -> tuple[str, int, int]:
    """A turn with text (1), role (2) or both (3) escaped, and where its text starts and ends."""
    role, text = (_escaped_role(role) if form & 2 else role), (escaped(text) if form & 1 else text)
    start = len(START) + len(role) + 1
    return f"{START}{role}\n{text}{END}\n", start, start + len(text)


def fitting_form(role: str, text: str) -> int:
    """The least escaped form of a turn that the parser reads back as it was."""
    for form in range(4):
        with suppress(NotInGrammar):
            if [t[:2] for t in parse(_written(role, text, form)[0])] == [(role, text)]:
                return form
    raise AssertionError("the escaped form always comes back")


def render(role: str, text: str) -> str:
    """One turn, escaped as far as its round trip needs."""
    return _written(role, text, fitting_form(role, text))[0]


def _formed(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conversation, turn, role, text in rows:
        yield conversation, turn, role, text, fitting_form(role, text)


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def format_conversations(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", part: int = PART) -> DataFrame:
    """Conversations as text: id, ``part`` (from 0), ``formatted``, and ``loss``, the spans of ``formatted`` (code
    points, end exclusive) that hold what the model learns to say."""
    given = rows.select(q(conversation).alias("_c"), q(turn).alias("_t"), F.coalesce(q(role), F.lit("")).alias("_r"),
                        F.coalesce(q(text), F.lit("")).alias("_x"))
    formed = streamed(given, _formed, T.StructType([*given.schema.fields, T.StructField("_form", T.LongType())]), text=3)
    ordered = in_order(formed, "_c", [F.col("_t").asc_nulls_first(), F.col("_r"), F.col("_x")])

    def parts(turns: Iterator[tuple]) -> Iterator[tuple]:
        for key, own in groupby(turns, key=itemgetter(0)):
            number, held, size, spans = 0, [], 0, []
            for _, _, role, text, form in own:
                piece, start, end = _written(role, text, form)
                if held and size + len(piece) > part:
                    yield key, number, "".join(held), spans
                    number, held, size, spans = number + 1, [], 0, []
                if role == LEARNT and text:
                    spans.append((size + start, size + end))
                held.append(piece)
                size += len(piece)
            yield key, number, "".join(held), spans

    return streamed(ordered, parts, T.StructType([
        T.StructField("_c", given.schema["_c"].dataType), T.StructField("part", T.LongType()),
        T.StructField("formatted", T.StringType()), T.StructField("loss", T.ArrayType(_SPAN))]), text=2) \
        .withColumnRenamed("_c", conversation)


def recovered_turns(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """The turns that the parser finds in formatted conversations: id, ``part``, ``place`` in it, ``role``, ``text``."""
    given = formatted.select(q(conversation).alias("_c"), "part", "formatted")

    def turns(rows: Iterable[tuple]) -> Iterator[tuple]:
        for key, part, text in rows:
            yield from ((key, part, k, *t[:2]) for k, t in enumerate(parse(text)))

    return streamed(given, turns, T.StructType([
        *given.schema.fields[:2], T.StructField("place", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType())]), text=4).withColumnRenamed("_c", conversation)


def read_back(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """What formatted conversations say when they are parsed: a row for each, with its number of turns, the digest of
    its turns, the code points and digest of the text under the loss mask, and the code points of the whole."""
    given = formatted.select(q(conversation).alias("_c"), "part", "formatted", "loss")

    def digests(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, parts in groupby(rows, key=itemgetter(0)):
            turns, said = hashlib.sha256(), hashlib.sha256()
            n_turns = learnt = size = 0
            for _, _, text, loss in parts:
                for role, body, _, _ in parse(text):
                    turns.update(f"{role}\n{body}\n".encode())
                    n_turns += 1
                for span in loss:
                    body = unescaped(text[span["start"]:span["end"]])
                    said.update(body.encode())
                    learnt += len(body)
                size += len(text)
            yield key, n_turns, turns.hexdigest(), learnt, said.hexdigest(), size

    whole, digest = T.LongType(), T.StringType()
    return streamed(in_order(given, "_c", [F.col("part")]), digests, T.StructType([
        given.schema.fields[0], T.StructField("n_turns", whole), T.StructField("turns_sha256", digest),
        T.StructField("loss_chars", whole), T.StructField("loss_sha256", digest), T.StructField("formatted_chars", whole)])) \
        .withColumnRenamed("_c", conversation)
