"""DuckDB SQL for the queries that it can express."""

ORACLE_SQL = {
    "op7_line_dedup": r"""
WITH line AS (
    SELECT doc_id, coalesce(source, '') AS host, source IS NULL AS no_host, text,
           unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM documents WHERE text IS NOT NULL
),
keyed AS (
    SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS key FROM line
),
site AS (SELECT coalesce(source, '') AS host, source IS NULL AS no_host, count(*) AS n_pages FROM documents GROUP BY ALL),
boilerplate AS (
    SELECT host, no_host, key
    FROM (SELECT host, no_host, key, count(DISTINCT doc_id) AS with_line FROM keyed WHERE key <> '' GROUP BY ALL) AS c
    JOIN site USING (host, no_host)
    WHERE with_line >= 5 AND with_line > 0.1 * n_pages
),
judged AS (
    SELECT k.doc_id, k.place, k.line, b.key IS NOT NULL AS bad
    FROM keyed AS k LEFT JOIN boilerplate AS b ON k.host = b.host AND k.no_host = b.no_host AND k.key = b.key
),
page AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE bad) AS n_dropped,
           coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT bad), '') AS left_text
    FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(p.n_lines, 0)::BIGINT AS n_lines, coalesce(p.n_dropped, 0)::BIGINT AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN sha256(p.left_text) END AS text_sha256
FROM documents AS d LEFT JOIN page AS p USING (doc_id)
""",
    "op11_hard_negatives": r"""
WITH vector AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS whole
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, v.vec_id AS other_id, a.label = v.label AS same,
           list_inner_product(a.whole, v.whole)::BIGINT AS score
    FROM vector AS a JOIN vector AS v ON a.vec_id <> v.vec_id
    WHERE a.vec_id % 100 = 0
),
positive AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id))::INTEGER AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive AS p JOIN scored AS s ON p.anchor_id = s.anchor_id
WHERE NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 5
""",
}
