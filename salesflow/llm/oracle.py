"""DuckDB SQL for the queries whose results SQL can express, written without the operators' own ways of dividing work."""

from __future__ import annotations

from .pii import BASE_SCORE, CONTEXT, CONTEXT_SCORE, CONTEXT_WORDS, IBAN_LENGTHS, KINDS
from .quality import ORACLE as QUALITY

#: Texts as hexadecimal digits, two a byte, so that bytes can be cut with substr; windows are cut from blocks of 500
#: bytes, since substr reads its text from the start.
REPEATS = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, k, substr(h, 1000 * k + 1, 1098) AS c
  FROM (SELECT doc_id, h, unnest(range(0, (length(h) // 2 - 50) // 500 + 1)) AS k FROM t WHERE length(h) >= 100)),
w AS MATERIALIZED (SELECT doc_id, 500 * k + j AS i, substr(c, 2 * j - 1, 100) AS s
  FROM (SELECT doc_id, k, c, unnest(range(1, least(500, length(c) // 2 - 49) + 1)) AS j FROM b)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
d AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev
  FROM w JOIN f USING (s) WHERE first < doc_id),
g AS (SELECT doc_id, i, sum(CASE WHEN i <= prev + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM d),
r AS (SELECT doc_id, min(i) AS a, max(i) + 49 AS z FROM g GROUP BY doc_id, g),
p AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS y FROM r),
k AS (SELECT doc_id, string_agg(substr(h, 2 * y + 1, 2 * (a - 1 - y)), '' ORDER BY a) AS kept, max(z) AS z,
    sum(z - a + 1) AS n_removed, count(*) AS n_spans FROM p JOIN t USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * z + 1), h))) AS kept_sha256
FROM t LEFT JOIN k ON k.doc_id = t.doc_id
"""

#: Whole vectors in fixed point; one whose components are not all finite is left out.
_FIXED = """
SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
"""

#: Assignments by scanning every entry, means by grouping; a round is two of the clauses.
_ASSIGN = """a{t} AS MATERIALIZED (SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
  SELECT v.vec_id, v.part, b.entry, list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM v JOIN b{t} b USING (part)) GROUP BY vec_id, part)"""
_MEANS = """b{u} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{t} b LEFT JOIN (
  SELECT part, entry, list(s ORDER BY place) AS x FROM (
    SELECT part, entry, place, CAST(floor(sum(c) / count(*)) AS BIGINT) AS s
    FROM (SELECT v.part, a.entry, unnest(v.x) AS c, unnest(range(1, len(v.x) + 1)) AS place FROM v JOIN a{t} a USING (vec_id, part))
    GROUP BY part, entry, place) GROUP BY part, entry) m USING (part, entry))"""
VECTOR_CODES = (
    "WITH r AS MATERIALIZED (" + _FIXED.format(scale=256) + """),
v AS MATERIALIZED (SELECT vec_id, k AS part, x[k * (len(x) // 16) + 1 : (k + 1) * (len(x) // 16)] AS x
  FROM (SELECT vec_id, x, unnest(range(0, 16)) AS k FROM r)),
b0 AS MATERIALIZED (SELECT part, n - 1 AS entry, x FROM v
  JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS n FROM r QUALIFY n <= 64) USING (vec_id)),
"""
    + ",\n".join(_ASSIGN.format(t=t) + ",\n" + _MEANS.format(t=t, u=t + 1) for t in (0, 1))
    + ",\n"
    + _ASSIGN.format(t=2)
    + """,
o AS (SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id),
s AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) AS h
  FROM (SELECT part, entry, unnest(x) AS c, unnest(range(1, len(x) + 1)) AS place FROM b2))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256
FROM o JOIN r USING (vec_id), s
"""
)

TOP_K = (
    "WITH r AS MATERIALIZED (" + _FIXED.format(scale=1024) + """)
SELECT query_id, rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, p.score,
    CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY p.score DESC, c.vec_id) AS INTEGER) AS rank
  FROM r q JOIN r c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id,
    LATERAL (SELECT list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2]))::BIGINT AS score) p)
WHERE rank <= 10
"""
)

#: The base patterns as the contract states them, and that of account numbers.
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": "|".join(rf"\b{code}[0-9][0-9]" + r"\x20?[A-Z0-9]" * (length - 4) + r"\b" for code, length in IBAN_LENGTHS.items()),
}
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = (
    f"list_sum(list_transform(string_split(reverse({_DIGITS}), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN c::INT "
    "WHEN c::INT > 4 THEN 2 * c::INT - 9 ELSE 2 * c::INT END)) % 10 = 0"
)
_BARE = "replace(m, ' ', '')"
_MOVED = f"list_transform(string_split({_BARE}[5:] || {_BARE}[:4], ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE c::INT END)"
_HOLDS = {
    "email": "true",
    "ip": "list_bool_and(list_transform(string_split(m, '.'), lambda p: p::HUGEINT <= 255))",
    "card": f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
    "iban": f"(array_to_string({_MOVED}, '')::BIGNUM % 97) = 1",
}


def _kind(kind: str, rank: int) -> str:
    """(doc_id, rank, kind, start, stop, score): matches and the gaps before them, and running sums of both."""
    words = "|".join(CONTEXT_WORDS[kind])
    return f"""
SELECT doc_id, {rank} AS rank, '{kind}' AS kind, start, start + length(m) AS stop,
  {BASE_SCORE[kind]} + CASE WHEN regexp_matches(lower(substr(text, greatest(start - {CONTEXT} + 1, 1), length(m) + 2 * {CONTEXT})),
    '\\b(?:{words})') THEN {CONTEXT_SCORE} ELSE 0 END AS score
FROM (SELECT doc_id, text, m, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT - length(m) AS start
  FROM (SELECT doc_id, text, unnest(regexp_extract_all(text, '{_PATTERNS[kind]}')) AS m, unnest(range(1, n + 1)) AS i,
      unnest(regexp_split_to_array(text, '{_PATTERNS[kind]}')[:n]) AS gap
    FROM (SELECT *, len(regexp_extract_all(text, '{_PATTERNS[kind]}')) AS n FROM t)))
WHERE {_HOLDS[kind]}"""


def _joined(what: str, where: str = "true") -> str:
    return f"coalesce(string_agg(kind || ':' || start::BIGINT || ':' || {what}::BIGINT, ',' ORDER BY rank, start) FILTER (kind IS NOT NULL AND {where}), '')"


PII = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_kind(k, i) for i, k in enumerate(KINDS))})
SELECT t.doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS)},
  sha256({_joined("stop", "kind <> 'iban'")}) AS base_sha256, {_joined("stop")} AS spans, {_joined("score")} AS scores
FROM t LEFT JOIN s ON s.doc_id = t.doc_id GROUP BY t.doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op4_repeated_passages": REPEATS,
    "op6_pii": PII,
    "op7_quality_rules": QUALITY,
    "op11_vector_codes": VECTOR_CODES,
    "op12_top_k": TOP_K,
}
