"""SQL of the registered queries that DuckDB can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"

OP12 = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), listed AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), placed AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM listed WHERE len(w) > 0
), grams AS (
    SELECT lang, size, array_to_string(w[p:p + size - 1], ' ') AS gram, count(*) AS n
    FROM placed, (SELECT unnest([1, 2, 3, 4]) AS size)
    WHERE p + size - 1 <= len(w)
    GROUP BY ALL
), totals AS (
    SELECT lang, sum(n)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang
), often AS (
    SELECT lang, size, gram, n, string_split(gram, ' ') AS w FROM grams WHERE n >= 30
), inside AS (
    SELECT lang, array_to_string(w[s:s + k - 1], ' ') AS gram, max(n) AS most
    FROM often, (SELECT unnest([1, 2, 3]) AS s), (SELECT unnest([2, 3]) AS k)
    WHERE k < size AND s + k - 1 <= size
    GROUP BY ALL
), phrases AS (
    SELECT o.* FROM often o LEFT JOIN inside i ON o.lang = i.lang AND o.gram = i.gram
    WHERE o.size > 1 AND NOT coalesce(100 * i.most >= 80 * o.n, false)
), cuts AS (
    SELECT p.lang, p.gram, p.n AS a, k, l.n AS l, r.n AS r,
           ((2000000::HUGEINT * p.n) // (l.n + r.n))::BIGINT AS score
    FROM phrases p, (SELECT unnest([1, 2, 3]) AS k), often l, often r
    WHERE k < p.size AND l.lang = p.lang AND l.gram = array_to_string(p.w[1:k], ' ')
      AND r.lang = p.lang AND r.gram = array_to_string(p.w[k + 1:p.size], ' ')
), weakest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.gram) AS rank,
       w.gram AS phrase, w.a, w.l, w.r, t.n, w.score
FROM weakest w JOIN totals t ON w.lang = t.lang
QUALIFY rank <= 2000
"""

OP13 = rf"""
WITH RECURSIVE listed AS (
    SELECT doc_id, list_filter(string_split_regex({LOWERED}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), shingled AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM listed
), sized AS (
    SELECT doc_id, s, len(s) AS n, sha256(array_to_string(list_sort(s), chr(10))) AS same FROM shingled
), classes AS (
    SELECT same, min(doc_id) AS rep, any_value(n) AS n, any_value(s) AS s FROM sized WHERE n > 0 GROUP BY same
), parts AS (
    SELECT rep, n, unnest(s) AS part FROM classes
), shared AS (
    SELECT a.rep AS x, b.rep AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS common
    FROM parts a JOIN parts b ON a.part = b.part AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.rep, b.rep
), links AS (
    SELECT x, y FROM shared WHERE 100 * common >= 90 * (nx + ny - common)
), ways AS (
    SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(rep, other) AS (
    SELECT rep, rep FROM classes
    UNION
    SELECT r.rep, w.y FROM reach r JOIN ways w ON r.other = w.x
), least_of AS (
    SELECT rep, min(other) AS component_id FROM reach GROUP BY rep
)
SELECT d.doc_id, d.n::BIGINT AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
FROM sized d LEFT JOIN classes c ON d.same = c.same AND d.n > 0 LEFT JOIN least_of l ON c.rep = l.rep
"""
