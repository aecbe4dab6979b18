"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

import string

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def words_sql(text: str) -> str:
    """The words of a text with A-Z in lower case, as a list."""
    return (
        f"list_filter(string_split_regex(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
        "'[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    )


def jaccard_sql(docs: str = "documents", size: int = 4, percent: int = 85) -> str:
    """CTEs up to ``component`` (doc_id, n, root)."""
    return f"""
d AS (SELECT doc_id, {words_sql("text")} AS w FROM {docs}),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))) END AS g
  FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
l AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.doc_id),
component AS (
  SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n, m.root FROM s
  JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) m USING (doc_id))"""


OP7 = f"""WITH RECURSIVE {jaccard_sql()}
SELECT doc_id, n AS n_shingles, root AS component_id FROM component"""

OP2 = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


ASSIGN = """(?i)(password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
PLACEHOLDER = "(?i)example|sample|dummy|placeholder|changeme|redacted|your|xxxx|" + "|".join(
    f"{c}{{8,}}" for c in [*string.digits, *string.ascii_letters, r"\+", "/", "_", r"\.", "=", "-"]
) + "|0123456|abcdef0"


def _matches(place: int, kind: str, pattern: str, group: int, keep: str) -> str:
    return f"""
m{place} AS (
  SELECT row_id, source, doc_id, {place} AS place, '{kind}' AS kind, unnest(list_transform(range(1, len(f) + 1), lambda i: {{
    'start': CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS BIGINT),
    'size': length(f[i]), 'value': v[i]}})) AS m
  FROM (SELECT row_id, source, doc_id, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}', 0) AS f,
    regexp_extract_all(t, '{pattern}', {group}) AS v FROM t)),
k{place} AS (
  SELECT row_id, source, doc_id, place, kind, m.start AS start, m.start + m.size AS stop, m.value AS value
  FROM m{place} WHERE {keep.replace("value", "m.value")})"""


OP3 = f"""WITH t AS (SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS t FROM documents),
{_matches(0, "assign", ASSIGN, 2, "length(value) >= 6")},
{_matches(1, "access", "AKIA[A-Z0-9]+", 0, "length(value) >= 20")},
{_matches(2, "hex", "[0-9a-f]{24,}", 0, "true")},
{_matches(3, "generic", "[A-Za-z0-9+/_-]{32,}", 0,
          "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')")},
s AS (SELECT * FROM k0 UNION ALL SELECT * FROM k1 UNION ALL SELECT * FROM k2 UNION ALL SELECT * FROM k3),
o AS (SELECT value, count(DISTINCT coalesce('s' || source, '')) AS owners FROM s GROUP BY value),
l AS (
  SELECT s.*, owners >= 3 AS copied, owners = 1 AND len(list_distinct(string_split(value, ''))) >= 10
    AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND NOT regexp_matches(value, '{PLACEHOLDER}') AS live
  FROM s JOIN o USING (value)),
g AS (
  SELECT row_id, count(*) FILTER (place = 0) AS a, count(*) FILTER (place = 1) AS b, count(*) FILTER (place = 2) AS c,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place < 3) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS every,
    count(*) FILTER (live) AS live, count(*) FILTER (copied) AS copied
  FROM l WHERE place < 3 OR live GROUP BY row_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans, coalesce(live, 0) AS n_live, coalesce(copied, 0) AS n_copied
FROM t LEFT JOIN g USING (row_id)"""
