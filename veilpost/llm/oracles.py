"""DuckDB SQL for the queries of this subpackage that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JACCARD = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), words AS (
    SELECT doc_id, len(words) AS n, generate_subscripts(words, 1) AS i, unnest(words) AS w FROM split
), windows AS (
    SELECT doc_id, n, i, w || coalesce(' ' || lead(w, 1) OVER p, '') || coalesce(' ' || lead(w, 2) OVER p, '')
           || coalesce(' ' || lead(w, 3) OVER p, '') AS gram
    FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY i)
), listed AS (
    SELECT doc_id, gram, count(*) OVER (PARTITION BY doc_id) AS n
    FROM (SELECT DISTINCT doc_id, gram FROM windows WHERE i = 1 OR i + 3 <= n)
), links AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM listed x JOIN listed y ON x.gram = y.gram AND x.doc_id <> y.doc_id
    GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))
), reached AS (
    SELECT a AS doc_id, b AS other FROM links
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
), nearest AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id
), sizes AS (SELECT doc_id, count(*) AS n FROM listed GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.other, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN nearest r ON r.doc_id = d.doc_id
"""

COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, part FROM (
        SELECT lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS part FROM documents)
), split AS (
    SELECT lang, piece, list_filter(regexp_split_to_array(part, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), words AS (
    SELECT lang, piece, generate_subscripts(words, 1) AS i, unnest(words) AS w FROM split
), totals AS (
    SELECT lang, count(*) AS n FROM words GROUP BY lang
), suffixes AS (
    SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3
    FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)
), counts AS (
    SELECT lang, 1 AS size, w1 AS phrase, w1 AS head1, NULL AS rest1, NULL AS head2, NULL AS rest2, count(*) AS f FROM suffixes GROUP BY ALL
    UNION ALL
    SELECT lang, 2, w1 || ' ' || w2, w1, w2, NULL, NULL, count(*) FROM suffixes WHERE w2 IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, w1, w2 || ' ' || w3, w1 || ' ' || w2, w3, count(*) FROM suffixes WHERE w3 IS NOT NULL GROUP BY ALL
), often AS (SELECT * FROM counts WHERE f >= 10
), cuts AS (
    SELECT lang, size, phrase, f AS a, 1 AS k, head1 AS head, rest1 AS rest FROM often WHERE size > 1
    UNION ALL
    SELECT lang, size, phrase, f, 2, head2, rest2 FROM often WHERE size > 2
), scored AS (
    SELECT c.lang, c.phrase, c.a, k, h.f AS l, r.f AS r, 1000000::HUGEINT * c.a * c.a // (h.f::HUGEINT * r.f) AS score
    FROM cuts c JOIN often h ON h.lang = c.lang AND h.phrase = head JOIN often r ON r.lang = c.lang AND r.phrase = rest
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), around AS (
    SELECT lang, part, max(f) AS longer
    FROM (SELECT lang, f, head2 AS part FROM often WHERE size = 3 UNION ALL SELECT lang, f, rest1 FROM often WHERE size = 3)
    GROUP BY ALL
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM best b JOIN totals t ON t.lang = b.lang LEFT JOIN around x ON x.lang = b.lang AND x.part = b.phrase
WHERE NOT coalesce(100 * x.longer >= 50 * b.a, false)
QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

ORACLES = {"op11_ngram_jaccard": NGRAM_JACCARD, "op12_collocations": COLLOCATIONS}
