"""Secret scans with corpus-wide ownership, in DataFrame operations only.

Base spans are the leftmost non-overlapping matches of three kinds (assign,
access, hex). Offsets come without any Python: ``split`` gives the gaps between
matches and ``regexp_extract_all`` the matches, both in order, so a running sum
of their lengths is each match's place in code points. Running sums go through an
array in stretches, so the work on a text grows with its matches, not their square.

The method then asks who owns each candidate value. Candidates are the base
values and every other token of 20 or more key characters with letters and
digits. Their hashes are aggregated over the whole corpus by distinct owners
and repositories: a value seen with more than ``max_owners`` owners or
``max_repositories`` repositories is a widely copied example; the others look
live. Live tokens that no base span covers are added as spans of kind ``owned``.

The aggregate is keyed by hash and first reduced to distinct (hash, owner,
repository), map-side, so a value copied into a third of all rows costs one row
a task; verdicts go back to the candidates by a plain join on the hash and to
documents by row number.

Nulls and odd rows: a null text counts as empty and has no spans; a null owner
or repository counts as one owner of its own; equal ids and repeated rows are
scanned separately (and, having the same owner, do not make a value common); an
empty table gives an empty result; an input column named like a result column
gives way to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verlog.llm.common import hold, others, put_away, q

# The kinds in their order, their patterns, and the least length of each.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
LEAST_ASSIGNED = 12


#: Elements that a running value is carried through at a time; see ``_running``.
_STRETCH = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not anew for every element that a lambda in it goes over."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, start: int, merge: Callable[[Column, Column], Column]) -> Column:
    """Each element of a long array merged with all before it. Stretches of the array are carried through one by one,
    from what all stretches before them come to, so that no list grows with the array while it is built."""
    long = F.lit(start).cast("long")

    def carried(some: Column, first: Column, before: bool) -> Column:
        empty = F.struct(first.alias("now"), F.expr("CAST(array() AS array<long>)").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            now = merge(acc["now"], x)
            return F.struct(now.alias("now"), F.concat(acc["out"], F.array(acc["now"] if before else now)).alias("out"))

        return F.aggregate(some, empty, step, lambda acc: acc["out"])

    def whole(array: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(array) - 1, F.lit(0)), F.lit(_STRETCH)),
                           lambda i: F.slice(array, i + 1, F.lit(_STRETCH)))

    def joined(stretches: Column) -> Column:
        starts = carried(F.transform(stretches, lambda some: F.aggregate(some, long, lambda a, b: merge(a, b))), long, True)
        return F.flatten(F.zip_with(stretches, starts, lambda some, first: carried(some, first, False)))

    return _let(values, lambda array: _let(whole(array), joined))


def _matches(text: Column, pattern: str) -> Column:
    """array<struct(start, end, value)>: every leftmost non-overlapping match, ends exclusive, in code points."""
    def placed(found: Column) -> Column:
        # The gap after the last match has no match of its own.
        lengths = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found,
                             lambda gap, value: (F.length(gap) + F.length(value)).cast("long"))
        return F.zip_with(_running(lengths, 0, lambda a, b: a + b), found, lambda end, value: F.struct(
            (end - F.length(value)).cast("int").alias("start"), end.cast("int").alias("end"), value.alias("value")))

    nothing = F.expr("CAST(array() AS array<struct<start:int,end:int,value:string>>)")
    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda found: F.when(F.size(found) == 0, nothing).otherwise(placed(found)))


def _outside(wide: Column, base: Column) -> Column:
    """The ``wide`` spans (kind 3) that overlap none of ``base``: of all spans by start, those before end no later than
    it starts, and those after start no sooner than it ends."""
    far = (1 << 31) - 1

    def free(spans: Column) -> Column:
        ended = _running(F.transform(spans, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0).cast("long")), 0, F.greatest)
        begins = F.reverse(_running(F.reverse(F.transform(
            spans, lambda s: F.when(s["kind"] < 3, s["start"]).otherwise(far).cast("long"))), far, F.least))
        open_ = F.filter(F.arrays_zip(spans.alias("s"), ended.alias("ended"), begins.alias("begins")), lambda z:
                         (z["s"]["kind"] == 3) & (z["ended"] <= z["s"]["start"]) & (z["begins"] >= z["s"]["end"]))
        return F.transform(open_, lambda z: z["s"])

    return F.when((F.size(wide) == 0) | (F.size(base) == 0), wide).otherwise(
        _let(F.array_sort(F.concat(base, wide)), free))


def _assigned(spans: Column) -> Column:
    """Assign matches whose value is long enough; the value becomes the assigned text only."""
    valued = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.regexp_extract(s["value"], ASSIGN, 1).alias("value")))
    return F.filter(valued, lambda s: F.length(s["value"]) >= LEAST_ASSIGNED)


def _labelled(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"),
        F.unhex(F.sha2(s["value"], 256)).alias("hash")))


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind in its order, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, "owned")])
    parts = F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def base_spans(text: Column) -> tuple[Column, Column, Column]:
    """The base matches of a non-null text by kind: array<struct(start, end, value)> each."""
    return _assigned(_matches(text, ASSIGN)), _matches(text, ACCESS), _matches(text, HEX)


def secret_spans(docs: DataFrame, text: str = "text", owner: str = "source", repository: str | None = "lang",
                 max_owners: int = 1, max_repositories: int = 2, carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``
    (base and owned), ``n_live`` and ``n_copied`` (candidate spans by verdict). A repository is
    the pair of ``owner`` and ``repository`` values (the owner alone if None)."""
    new = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied"]
    kept = others(docs, new) if carry is None else carry
    away, back = put_away(kept)
    body = docs.select(*away, F.coalesce(q(text), F.lit("")).alias("whole"), q(owner).cast("string").alias("owner"),
                       q(repository or owner).cast("string").alias("repository"),
                       F.monotonically_increasing_id().alias("at"))
    whole = F.col("whole")
    assign, access, hexes = base_spans(whole)
    wide = F.filter(_matches(whole, TOKEN), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    rows = hold(body.select(*[f"_in_{i}" for i in range(len(kept))], "owner", "repository", "at",
                             _labelled(assign, 0).alias("assign"), _labelled(access, 1).alias("access"),
                             _labelled(hexes, 2).alias("hex"), _labelled(wide, 3).alias("wide")))
    base = F.concat("assign", "access", "hex")
    # A token that touches a base span is that span's own text.
    each = rows.select("at", "owner", "repository", F.explode(F.concat(base, _outside(F.col("wide"), base))).alias("s"))
    where = F.struct("owner", "repository")
    seen = each.select(F.col("s.hash").alias("hash"), "owner", "repository").distinct()
    verdict = (seen.groupBy("hash")
               .agg((F.count_distinct(F.struct("owner")) <= max_owners).alias("few_owners"),
                    (F.count_distinct(where) <= max_repositories).alias("few_repositories"))
               .select(F.col("hash").alias("v_hash"), (F.col("few_owners") & F.col("few_repositories")).alias("live")))
    judged = (each.join(verdict, F.col("s.hash") == F.col("v_hash")).groupBy(F.col("at").alias("j_at"))
              .agg(F.sum(F.col("live").cast("long")).alias("n_live"),
                   F.sum((~F.col("live")).cast("long")).alias("n_copied"),
                   F.collect_list(F.when(F.col("live") & (F.col("s.kind") == 3), F.col("s"))).alias("owned")))
    none = F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int,hash:binary>>)")
    return (rows.join(judged, F.col("at") == F.col("j_at"), "left")
            .select(*back, F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"),
                    F.size("hex").cast("long").alias("n_hex"),
                    F.sha2(_joined(base), 256).alias("base_sha256"),
                    _joined(F.concat(base, F.coalesce("owned", none))).alias("spans"),
                    F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
                    F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied")))
