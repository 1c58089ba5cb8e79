"""SQL for DuckDB that gives the rows of those registered queries that SQL can express."""

from llm.secrets import BASE, RULES

#: Shingle sets compared over an inverted index, then components by recursion.
OP5 = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)), links AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, k.y FROM reach r JOIN links k ON k.x = r.y)
SELECT d.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, m.c = d.doc_id AS kept FROM documents d JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) m ON m.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

#: All pairs of a label, then components by recursion.
OP6 = """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND list_dot_product(e, e) > 0 AND isfinite(list_dot_product(e, e))),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT v.vec_id, CAST((SELECT count(*) FROM links WHERE links.x = v.vec_id) AS BIGINT) AS n_links, min(r.y) AS component_id, min(r.y) = v.vec_id AS kept FROM v JOIN reach r ON r.x = v.vec_id GROUP BY v.vec_id"""


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_RULES = ", ".join(f"({k}, {_quoted(r.kind)}, {_quoted(r.pattern)}, {_quoted(r.keep or r.pattern)})" for k, r in enumerate(RULES))
#: Matches of every rule's pattern and what lies between them give the places.
OP10 = f"""WITH d AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents), r(k, kind, pattern, keep) AS (VALUES {_RULES}),
m AS (SELECT doc_id, k, kind, keep, regexp_extract_all(t, pattern) AS ms, string_split_regex(t, pattern) AS gaps FROM d, r WHERE regexp_matches(t, pattern)),
e AS (SELECT doc_id, k, kind, keep, unnest(ms) AS x, unnest([list_sum([length(g) FOR g IN gaps[1:i]]) + COALESCE(list_sum([length(y) FOR y IN ms[1:i - 1]]), 0) FOR i IN range(1, len(ms) + 1)]) AS s FROM m),
f AS (SELECT doc_id, k, kind, CAST(s AS BIGINT) AS s, CAST(s AS BIGINT) + length(x) AS z FROM e WHERE regexp_full_match(x, keep)),
g AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex, count(*) FILTER (WHERE k >= {BASE}) AS n_added, string_agg(kind || ':' || s || ':' || z, ',' ORDER BY s, k) FILTER (WHERE k < {BASE}) AS base, string_agg(kind || ':' || s || ':' || z, ',' ORDER BY s, k) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex, sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans, COALESCE(n_added, 0) AS n_added FROM d LEFT JOIN g USING (doc_id)"""


def _lloyd(k: int, rounds: int) -> str:
    """Rounds over all vectors, one common table expression each; sums are floored by an exact division."""
    nearest = lambda c: f"SELECT a.vec_id, a.v, min_by((a.c, a.d), (a.d, a.c)) AS m FROM (SELECT q.vec_id, q.v, {c}.c, list_sum([(q.v[i] - {c}.v[i]) * (q.v[i] - {c}.v[i]) FOR i IN range(1, 65)])::BIGINT AS d FROM q, {c}) a GROUP BY a.vec_id, a.v"
    parts = [
        "q AS MATERIALIZED (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT sha256('3:' || vec_id) AS h, v FROM q ORDER BY h LIMIT {k}))",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({nearest(f'c{r}')})")
        parts.append(f"s{r} AS MATERIALIZED (SELECT m[1] AS c, [list_sum([w[i] FOR w IN ws]) FOR i IN range(1, 65)] AS s, len(ws) AS n FROM (SELECT m, list(v) AS ws FROM (SELECT [m[1]] AS m, v FROM a{r}) GROUP BY m))")
        parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.c, CASE WHEN n IS NULL THEN v ELSE [(CAST(x AS BIGINT) - ((CAST(x AS BIGINT) % n) + n) % n) // n FOR x IN s] END AS v FROM c{r} LEFT JOIN s{r} ON s{r}.c = c{r}.c)")
    parts.append(f"f AS MATERIALIZED ({nearest(f'c{rounds}')})")
    return f"WITH {', '.join(parts)} SELECT f.vec_id, CAST(f.m[1] AS INTEGER) AS cluster, f.m[2] AS distance, CAST(sum(f.m[2]) OVER (PARTITION BY f.m[1]) AS BIGINT) AS cluster_inertia, CAST(sum(f.m[2]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM f JOIN c{rounds} c ON c.c = f.m[1]"


OP11 = _lloyd(8, 10)

#: All anchors against all vectors.
OP13 = """WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
