"""The training-data queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

OP6 = r"""
WITH keys AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept,
       text_sha256
FROM keys
WINDOW best AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id)
"""

_FIELDS = [("doc_id", "doc_id"), ("source", "source"), ("lang", "lang"), ("n", "n_chars"), ("text", "text")]


def _leaf(n: str) -> str:
    parts = (f"coalesce(octet_length(encode(CAST({n if c == 'n' else v} AS VARCHAR))) || ':' || CAST({n if c == 'n' else v} AS VARCHAR), '-')" for c, v in _FIELDS)
    return f"sha256({' || '.join(parts)})"


#: CRC-32 of the decimal id: bit by bit over its characters.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)))"""


def _tree(name: str, group: str, source: str, leaf: str) -> str:
    """Every node of a tree per group, from its leaves up; and the siblings of every leaf, ``L`` or ``R`` before the hash."""
    return f"""
{name}(grp, lvl, rank, h, n) AS (
  SELECT {group}, 0, rank, {leaf}, count(*) OVER (PARTITION BY {group}) FROM {source}
  UNION ALL
  SELECT grp, lvl + 1, rank // 2, sha256(string_agg(h, '' ORDER BY rank)), (any_value(n) + 1) // 2 FROM {name} WHERE n > 1 GROUP BY grp, lvl, rank // 2
),
{name}_proof AS (
  SELECT l.grp, l.rank, list(CASE WHEN (l.rank >> p.lvl) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '') ORDER BY p.lvl) AS siblings
  FROM {name} l
  JOIN {name} p ON p.grp IS NOT DISTINCT FROM l.grp AND p.rank = l.rank >> p.lvl AND p.n > 1
  LEFT JOIN {name} s ON s.grp IS NOT DISTINCT FROM l.grp AND s.lvl = p.lvl AND s.rank = xor(p.rank, 1)
  WHERE l.lvl = 0
  GROUP BY l.grp, l.rank
)"""


OP11 = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
  FROM (SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("n_chars + 1")} END AS tampered FROM documents)
),{_tree("nodes", "lang", "leaves", "leaf")},
subroots AS (
  SELECT grp AS lang, h, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS rank FROM nodes WHERE n = 1
),{_tree("tops", "0", "subroots", "h")},
proofs AS (
  SELECT l.doc_id, l.leaf, l.tampered, s.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root,
         list_concat(coalesce(p.siblings, []), coalesce(t.siblings, [])) AS siblings
  FROM leaves l
  JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN nodes_proof p ON p.grp IS NOT DISTINCT FROM l.lang AND p.rank = l.rank
  LEFT JOIN tops_proof t ON t.rank = s.rank
)
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(siblings, lambda s: s[2:]), '')) AS proof_sha256,
       list_reduce(list_prepend(coalesce(tampered, leaf), siblings), lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root,
       folded_root = root AS verified
FROM proofs
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_exact_dedup": OP6, "op11_merkle": OP11}
