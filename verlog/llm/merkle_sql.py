"""The manifest of ``documents`` in DuckDB SQL: every level written out, for up to 8 ** LEVELS rows a language."""

from __future__ import annotations

LEVELS, TOP_LEVELS = 8, 3


def _nibble(value: int) -> int:
    for _ in range(4):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


_TABLE = "[" + ", ".join(f"{_nibble(i)}::BIGINT" for i in range(16)) + "]"


def _crc32(text: str) -> str:
    def four_bits(c: str) -> str:
        return f"xor(({_TABLE})[(({c}) & 15) + 1], ({c}) >> 4)"

    bytes_ = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    start = "list_value(4294967295::BIGINT)"
    return f"xor(list_reduce(list_concat({start}, {bytes_}), lambda c, b: {four_bits(four_bits('xor(c, b)'))}), 4294967295)"


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, levels: int) -> list[str]:
    """CTEs of a tree over ``<name>0`` (g, i, n, h): its levels, and beside each node what its run has left and right of it."""
    out = []
    for k in range(levels):
        out.append(f"""{name}{k}_beside AS (SELECT g, i, n,
            coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS (SELECT g, i // 8 AS i, (max(n) + 7) // 8 AS n,
            CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY g, i // 8)""")
    return out


def _climb(source: str, name: str, levels: int, group: str) -> list[str]:
    """CTEs that lead the rows of ``source`` (with place i, fold f and proof p) up the tree ``name``."""
    out = []
    for k in range(levels):
        out.append(f"""{name}_up{k} AS (SELECT s.* REPLACE (s.i // 8 AS i,
            CASE WHEN b.n = 1 THEN s.f ELSE sha256(b.l || s.f || b.r) END AS f, s.p || b.l || b.r AS p)
            FROM {source if k == 0 else f'{name}_up{k - 1}'} s JOIN {name}{k}_beside b ON b.g = {group} AND b.i = s.i)""")
    return out


def _tampered() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return _leaf(f"translate(text, '{upper}', '{upper.lower()}')")


SQL = "WITH " + ",\n".join([
    f"""leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf('text')} AS leaf,
        CASE WHEN {_crc32('doc_id::VARCHAR')} % 3 = 0 THEN {_tampered()} END AS other FROM documents)""",
    """placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY g) AS n FROM leaves)""",
    "t0 AS (SELECT g, i, n, leaf AS h FROM placed)",
    *_tree("t", LEVELS),
    f"""top0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n, h, g AS name FROM t{LEVELS})""",
    *_tree("top", TOP_LEVELS),
    "start AS (SELECT doc_id, leaf, g, i, coalesce(other, leaf) AS f, '' AS p FROM placed)",
    *_climb("start", "t", LEVELS, "s.g"),
    f"""groups AS (SELECT u.* REPLACE (x.i AS i), x.h AS subroot FROM t_up{LEVELS - 1} u JOIN top0 x ON x.name = u.g)""",
    *_climb("groups", "top", TOP_LEVELS, "''"),
]) + f"""
SELECT doc_id, leaf, subroot, r.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = r.h AS verified
FROM top_up{TOP_LEVELS - 1}, top{TOP_LEVELS} r"""
