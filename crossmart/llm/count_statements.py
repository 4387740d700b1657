"""DuckDB twins of the phrase, MinHash and filter audit queries; every fixed value is written out."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MINHASH = rf"""
WITH RECURSIVE tok AS (
  SELECT row_number() OVER () AS id, doc_id,
         list_filter(regexp_split_to_array({LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
sets AS (
  SELECT id, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM tok
),
one AS (SELECT id, unnest(s) AS g FROM sets),
shared AS (SELECT a.id AS a, b.id AS b, count(*) AS n FROM one a JOIN one b ON a.g = b.g AND a.id <> b.id GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM shared JOIN sets x ON x.id = a JOIN sets y ON y.id = b WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)
),
reach AS (SELECT id AS a, id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a),
least AS (SELECT r.a AS id, min(d.doc_id) AS component_id FROM reach r JOIN sets d ON d.id = r.b GROUP BY 1)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (id)"""

AUDIT = r"""
WITH RECURSIVE tok AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
judged AS (
  SELECT part, doc_id,
         len(w) < 100 AS a,
         100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE) AS e
  FROM tok
),
said AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels GROUP BY doc_id),
doc AS (
  SELECT part, [a, b, c, d, e] AS fails, coalesce(good, FALSE) AS good, coalesce(bad, FALSE) AS bad, count(*) AS n
  FROM judged LEFT JOIN said USING (doc_id) GROUP BY ALL
),
orders AS (
  SELECT '' AS o
  UNION ALL
  SELECT o || l FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS t(l) WHERE NOT contains(o, l)
),
steps AS (
  SELECT o AS filter_order, step::INTEGER AS step, ascii(o[step]) - 64 AS f,
         list_transform(range(1, step), lambda k: ascii(o[k]) - 64) AS earlier
  FROM orders, (VALUES (1), (2), (3), (4), (5)) AS t(step) WHERE length(o) = 5
),
met AS (
  SELECT part, filter_order, step, f, n, good, bad, fails[f] AS failing,
         len(list_filter(earlier, lambda k: fails[k])) > 0 AS gone,
         len(list_filter(fails, lambda x: x)) = 1 AS only_one
  FROM doc, steps
),
per AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (NOT gone AND failing), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (gone AND failing), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (failing AND only_one), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (NOT gone AND failing AND good), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (NOT gone AND failing AND bad), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM per"""

#: All phrases with their counts, the lowest cut of each candidate, absorbed ones dropped, the best of every language.
PHRASES = rf"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
tok AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
),
runs AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM tok), (VALUES (1), (2), (3), (4), (5)) AS t(m)
  WHERE i + m - 1 <= len(w)
),
f AS (SELECT lang, m, phrase, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, sum(len(w)) AS n FROM tok GROUP BY lang),
cand AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
absorbed AS (
  SELECT DISTINCT s.lang, inner_phrase AS phrase FROM (
    SELECT c.lang, c.a AS longer, unnest([array_to_string(w[:m - 1], ' '), array_to_string(w[2:], ' ')]) AS inner_phrase FROM cand c
  ) AS o JOIN cand s ON s.lang = o.lang AND s.phrase = inner_phrase WHERE 100 * longer >= 100 * s.a
),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)
),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, x.a AS l, y.a AS r, n, k,
         (1000::HUGEINT * cut.a::HUGEINT * n::HUGEINT) // (x.a::HUGEINT * y.a::HUGEINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = head JOIN f y ON y.lang = cut.lang AND y.phrase = rest
  JOIN total ON total.lang = cut.lang
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest ANTI JOIN absorbed USING (lang, phrase)
QUALIFY rank <= 2000"""
