"""DuckDB SQL for the queries that SQL can express; each says what the result is, by a plain way of its own."""

from __future__ import annotations

URL_FILTERS = r"""
WITH rules(host, path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), cut AS (
    SELECT page_id, row_number() OVER () AS row,
           CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parsed AS (
    SELECT page_id, row,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM cut
), ranked AS (
    SELECT p.*, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY row ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS n
    FROM parsed p LEFT JOIN rules r
      ON (p.host = r.host OR suffix(p.host, '.' || r.host)) AND prefix(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE n = 1
"""

SOURCE_MIXING = r"""
WITH RECURSIVE sizes AS (
    SELECT source, sum(coalesce(length(text), 0)) AS chars FROM documents GROUP BY source
), rates AS (
    SELECT source, coalesce(CASE WHEN chars > 0 THEN
             (1.0::DOUBLE / (SELECT count(*) FILTER (chars > 0) FROM sizes)) * (SELECT sum(chars) FROM sizes)::DOUBLE / chars END, 1.0) AS rate
    FROM sizes
), means AS (
    SELECT source, greatest(ceil(rate / 32), 1)::INT AS draws, rate / greatest(ceil(rate / 32), 1)::INT AS mean FROM rates
), cdf(source, mean, k, p, c) AS (
    SELECT source, mean, 0, exp(-mean), exp(-mean) FROM means
    UNION ALL
    SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < 128
), steps AS (
    SELECT source, list(c ORDER BY k) AS terms FROM cdf GROUP BY source
), drawn AS (
    SELECT d.*, list_sum(list_transform(range(1, m.draws + 1), lambda j: len(list_filter(s.terms, lambda c:
             c <= ('0x' || substr(md5(concat_ws(':', '0', d.doc_id::VARCHAR, j::VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0)))) AS n
    FROM documents d JOIN means m ON d.source IS NOT DISTINCT FROM m.source JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n::BIGINT + 1))::INT AS replica FROM drawn WHERE n > 0
"""

HARD_NEGATIVES = r"""
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.other AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other) AS rank,
       s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
QUALIFY rank <= 10
"""

LEXICAL_SEARCH = r"""
WITH texts AS (
    SELECT 'd' AS kind, row_number() OVER () AS row, doc_id AS id, text FROM documents
    UNION ALL SELECT 'q', row_number() OVER (), item_id, text FROM benchmark
), words AS (
    SELECT kind, row, id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM texts
), counts AS (
    SELECT row, id, term, count(*) AS tf FROM words WHERE kind = 'd' GROUP BY ALL
), sizes AS (
    SELECT row, sum(tf)::BIGINT AS n FROM counts GROUP BY row
), total AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM sizes
), weights AS (
    SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, total GROUP BY term, docs
), scores AS (
    SELECT q.row AS item, q.id AS item_id, c.row, c.id AS doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::BIGINT AS score
    FROM (SELECT DISTINCT row, id, term FROM words WHERE kind = 'q') q JOIN counts c USING (term) JOIN weights USING (term)
    JOIN sizes ON sizes.row = c.row, total
    GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, row) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""

ORACLE = {
    "op1_url_filters": URL_FILTERS,
    "op7_source_mixing": SOURCE_MIXING,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_lexical_search": LEXICAL_SEARCH,
}
