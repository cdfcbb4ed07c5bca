"""SQL for the queries it can express, in DuckDB's dialect."""

from __future__ import annotations

# CRC-32 as the standard has it: its polynomial, reversed.
_CRC_STEP = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
#: ``t.crc``: the checksum's table of 16 entries, one for each half of a byte.
_CRC_TABLE = f"t AS (SELECT list_transform(range(16), lambda n: list_reduce(range(4), lambda c, i: {_CRC_STEP}, n)) AS crc)"


def _crc32(text: str) -> str:
    """CRC-32 of UTF-8 text, from a hex column, half a byte a step, the lower half of a byte first."""
    digit = "CAST('0x' || h[CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END] AS BIGINT)"
    return (
        f"(SELECT xor(4294967295, list_reduce(list_transform(range(length(h)), lambda i: {digit}), "
        "lambda c, x: xor(c // 16, crc[xor(c % 16, x) + 1]), 4294967295)) "
        f"FROM (SELECT hex(encode({text})) AS h), t)"
    )


SHARDS = f"""
    WITH {_CRC_TABLE},
    sized AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {_crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
    summed AS (SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM sized),
    dealt AS (SELECT *, CAST((2 * before + size) * 8 // (2 * total) AS INTEGER) AS shard FROM summed)
    SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, shard,
        row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM dealt"""


def _field(value: str) -> str:
    shown = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({shown}) || ':' || {shown}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _tree(name: str, depth: int) -> str:
    """Levels ``{name}0`` to ``{name}{depth}`` of (tree, idx, h, m: nodes of the level), from the first; a tree
    whose level has one node stays as it is."""
    return ",\n".join(
        f"""{name}{k + 1} AS (SELECT tree, idx // 2 AS idx, (max(m) + 1) // 2 AS m,
            CASE WHEN max(m) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h FROM {name}{k} GROUP BY tree, idx // 2)"""
        for k in range(depth)
    )


def _climb(steps: str, level: str, first: str, depth: int) -> str:
    """``{steps}0`` to ``{steps}{depth}``: the proof and the fold of each row (tree, idx, proof, f) up the tree."""
    parts = [f"{steps}0 AS ({first})"]
    for k in range(depth):
        folded = "CASE WHEN (s.idx >> %d) %% 2 = 1 THEN coalesce(o.h, '') || s.f ELSE s.f || coalesce(o.h, '') END" % k
        parts.append(
            f"""{steps}{k + 1} AS (SELECT s.* REPLACE (s.proof || coalesce(o.h, '') AS proof, CASE WHEN l.m = 1 THEN s.f ELSE sha256({folded}) END AS f)
            FROM {steps}{k} s JOIN {level}{k} l ON l.tree = s.tree AND l.idx = s.idx >> {k}
            LEFT JOIN {level}{k} o ON o.tree = s.tree AND o.idx = xor(s.idx >> {k}, 1))"""
        )
    return ",\n".join(parts)


#: Enough for 2**20 documents of a language and 2**8 languages.
_LOW, _HIGH = 20, 8

MERKLE = f"""
    WITH {_CRC_TABLE},
    d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
        CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS claimed,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS m FROM documents),
    a0 AS (SELECT tree, idx, m, leaf AS h FROM d),
    {_tree("a", _LOW)},
    b0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS m, h, tree AS own FROM a{_LOW}),
    {_tree("b", _HIGH)},
    {_climb("p", "a", "SELECT doc_id, leaf, tree, idx, '' AS proof, claimed AS f FROM d", _LOW)},
    {_climb("q", "b", f"SELECT p.doc_id, p.leaf, b.h AS subroot, b.tree, b.idx, p.proof, p.f FROM p{_LOW} p JOIN b0 b ON b.own = p.tree", _HIGH)}
    SELECT q.doc_id, q.leaf, q.subroot, r.h AS root, sha256(q.proof) AS proof_sha256, q.f AS folded_root, q.f = r.h AS verified
    FROM q{_HIGH} q, b{_HIGH} r"""
