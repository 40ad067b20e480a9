"""The Merkle manifest in SQL: trees by recursive queries, one level a step."""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, b: list_reduce([xor(crc, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)), CAST(4294967295 AS BIGINT))"""

_UP = """SELECT level + 1, g, i // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY i)) FROM {tree} WHERE n > 1 GROUP BY level, g, i // 2, n"""

_FOLD = """SELECT f.row, f.level + 1, f.g, f.i // 2, (f.n + 1) // 2, sha256(CASE WHEN f.i % 2 = 1 THEN s.hash || f.acc ELSE f.acc || coalesce(s.hash, '') END)
  FROM {fold} f LEFT JOIN {tree} s ON s.level = f.level AND s.g = f.g AND s.i = xor(f.i, 1) WHERE f.n > 1"""

MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '') AS g, {_leaf("n_chars")} AS leaf,
    CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS altered
  FROM documents
), p AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d
), tree(level, g, i, n, hash) AS (
  SELECT 0, g, i, n, leaf FROM p UNION ALL {_UP.format(tree="tree")}
), sub AS (
  SELECT g, hash, row_number() OVER (ORDER BY g COLLATE "binary") - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1
), top(level, g, i, n, hash) AS (
  SELECT 0, '', i, n, hash FROM sub UNION ALL {_UP.format(tree="top")}
), fold(row, level, g, i, n, acc) AS (
  SELECT row, 0, g, i, n, coalesce(altered, leaf) FROM p UNION ALL {_FOLD.format(fold="fold", tree="tree")}
), peak(row, level, g, i, n, acc) AS (
  SELECT f.row, 0, '', sub.i, sub.n, f.acc FROM fold f JOIN sub USING (g) WHERE f.n = 1 UNION ALL {_FOLD.format(fold="peak", tree="top")}
), low AS (
  SELECT p.row, string_agg(s.hash, '' ORDER BY s.level) AS t FROM p JOIN tree s ON s.g = p.g AND s.i = xor(p.i >> s.level, 1) GROUP BY p.row
), high AS (
  SELECT sub.g, string_agg(s.hash, '' ORDER BY s.level) AS t FROM sub JOIN top s ON s.i = xor(sub.i >> s.level, 1) GROUP BY sub.g
), root AS (SELECT hash AS root FROM top WHERE n = 1)
SELECT p.doc_id, p.leaf, sub.hash AS subroot, root.root, sha256(coalesce(low.t, '') || coalesce(high.t, '')) AS proof_sha256,
  peak.acc AS folded_root, peak.acc = root.root AS verified
FROM p JOIN sub USING (g) JOIN peak ON peak.row = p.row AND peak.n = 1 LEFT JOIN low ON low.row = p.row LEFT JOIN high ON high.g = p.g, root
"""
