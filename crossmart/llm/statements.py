"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from crossmart.llm import mixing, quality, site_lines
from crossmart.llm.count_statements import AUDIT, MINHASH, PHRASES

SPACE = r"[\x20\x09-\x0D]"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rule_holds(rule: quality.Rule) -> str:
    base = rule.per or "1"
    parts = []
    if rule.low is not None:
        parts.append(f"{rule.measure}::DOUBLE >= {float(rule.low)}::DOUBLE * {base}")
    if rule.high is not None:
        parts.append(f"{rule.measure}::DOUBLE <= {float(rule.high)}::DOUBLE * {base}")
    return "(" + " AND ".join(parts) + ")"


QUALITY = rf"""
WITH body AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
tok AS (
  SELECT id, doc_id, text, list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM body
),
windows AS (
  SELECT id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT id, words, unnest(range(1, len(words) - 1)) AS i FROM tok)
),
again AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS t(k) GROUP BY id),
measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '{quality.SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda x: lower(x) IN ({', '.join(map(quoted, quality.STOP_WORDS))}))) AS n_stop_words
  FROM tok LEFT JOIN covered USING (id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND {' AND '.join(rule_holds(r) for r in quality.RULES)} AS kept
FROM measured"""

#: A source's rate, the Poisson distribution of its mean, and as many copies of a document as its draws say.
MIXING = rf"""
WITH RECURSIVE per_source AS (
  SELECT source AS name, sum(strlen(coalesce(text, '')) + 1)::DOUBLE AS size FROM documents GROUP BY source
),
rates AS (
  SELECT name, 1.0::DOUBLE / (SELECT count(*) FROM per_source)::DOUBLE * (SELECT sum(size) FROM per_source) / size AS rate
  FROM per_source
),
means AS (
  SELECT name, rate, parts, rate / parts AS mean
  FROM (SELECT *, greatest(1, ceil(rate / {mixing.LARGEST_PART}))::INT AS parts FROM rates)
),
distribution AS (
  SELECT name, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c, ceil(mean + 12 * sqrt(mean) + 30)::INT AS steps FROM means
  UNION ALL
  SELECT name, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1), steps FROM distribution WHERE k + 1 < steps
),
draws AS (
  SELECT d.*, rate, i, (('0x' || substr(md5('{mixing.SEED}:' || i || ':' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5::DOUBLE)
         / pow(2::DOUBLE, 52) AS u
  FROM (SELECT row_number() OVER () AS id, * FROM documents) d JOIN means ON source IS NOT DISTINCT FROM name,
       LATERAL (SELECT unnest(range(1, parts + 1)) AS i)
),
drawn AS (
  SELECT id, count(*)::INT AS n_copies FROM draws JOIN distribution ON source IS NOT DISTINCT FROM name AND u >= c GROUP BY id
),
copies AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, unnest(range(0, n_copies))::INT AS copy, n_copies, d.rate
  FROM draws d JOIN drawn USING (id) WHERE d.i = 1
)
SELECT *, row_number() OVER (ORDER BY md5('{mixing.SEED}-order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, '')) || ':' || copy), text) - 1 AS position
FROM copies"""


def decoded(column: str) -> str:
    for name, char in site_lines.REFERENCES:
        column = f"replace({column}, {quoted(name)}, {quoted(char)})"
    return column


BARE = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
BLOCKS = rf"(?is)</?({'|'.join(site_lines.BLOCK_TAGS)})({SPACE}[^>]*)?/?>"
SITE_LINES = rf"""
WITH read AS (
  SELECT row_number() OVER () AS id, page_id, url,
         lower(regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1),
           '^.*@', ''), ':[0-9]*$', '')) AS host,
         regexp_replace(regexp_replace(coalesce(html, ''), '{BARE}', chr(10), 'g'), '{BLOCKS}', chr(10), 'g') AS blocks
  FROM pages
),
shown AS (SELECT * EXCLUDE (blocks), regexp_replace(blocks, '(?s)<[A-Za-z/!][^>]*>', '', 'g') AS body FROM read),
split AS (
  SELECT * EXCLUDE (body), list_filter(list_transform(string_split(
           regexp_replace({decoded('body')}, '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines
  FROM shown
),
line AS (SELECT id, host, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS k FROM split),
gone AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT id) AS n_pages FROM line GROUP BY host, line)
  JOIN (SELECT host, count(*) AS host_pages FROM read GROUP BY host ) USING (host)
  WHERE n_pages >= 3 AND n_pages - 0.05::DOUBLE * host_pages > 1.96::DOUBLE * sqrt(0.0475::DOUBLE * host_pages)
),
kept AS (
  SELECT id, count(*) AS n, string_agg(line, chr(10) ORDER BY k) AS text
  FROM line ANTI JOIN gone USING (host, line) GROUP BY id
)
SELECT page_id, url, host, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
       coalesce(text, '') AS text
FROM split LEFT JOIN kept USING (id)"""

STATEMENTS: dict[str, str] = {
    "op2_quality_rules": QUALITY,
    "op4_source_mixing": MIXING,
    "op10_line_dedup": SITE_LINES,
    "op11_phrase_collocations": PHRASES,
    "op12_minhash_near_dedup": MINHASH,
    "op13_filter_interactions": AUDIT,
}
