"""DuckDB SQL for the deduplicating operators and the quality rules, from the plain texts.

The statements say what the contracts say, over windows of all words or bytes;
they know nothing of shards, anchors or trees. A NULL id is the largest.
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUBSTRING_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS i,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), t AS (
  SELECT r, i, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d
), g AS (
  SELECT r, i, p, word, CASE WHEN count(*) OVER s = 13 THEN string_agg(word, ' ') OVER s END AS k
  FROM t WINDOW s AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
), f AS (
  SELECT k, min(i) AS least FROM g WHERE k IS NOT NULL GROUP BY k
), c AS (
  SELECT r, p, word, coalesce(bool_or(least < i) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), false) AS gone
  FROM g LEFT JOIN f USING (k)
), x AS (
  SELECT r, count(*) AS n, count(*) FILTER (gone) AS n_gone, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept FROM c GROUP BY r
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(n_gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN x USING (r)
"""

BYTES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS i, hex(encode(coalesce(text, ''))) AS h FROM documents
), t AS (
  SELECT r, i, h, unnest(range(1, len(h) // 2 + 1)) AS p FROM d
), g AS (
  SELECT r, i, p, substr(h, 2 * p - 1, 2) AS b, CASE WHEN len(h) >= 2 * p + 98 THEN substr(h, 2 * p - 1, 100) END AS k FROM t
), f AS (
  SELECT k, min(i) AS least FROM g WHERE k IS NOT NULL GROUP BY k
), c AS (
  SELECT r, p, b, coalesce(bool_or(least < i) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
  FROM g LEFT JOIN f USING (k)
), e AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY p), false) AS opens FROM c
), x AS (
  SELECT r, count(*) FILTER (gone) AS n_gone, count(*) FILTER (opens) AS spans, string_agg(b, '' ORDER BY p) FILTER (NOT gone) AS kept FROM e GROUP BY r
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN x USING (r)
"""

JOIN_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), t AS (
  SELECT r, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d
), g AS (
  SELECT DISTINCT r, k FROM (
    SELECT r, p, n, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS k FROM t)
  WHERE p <= greatest(1, n - 3)
), a AS (  -- texts with equal sets are one class
  SELECT r, count(*) AS n, string_agg(k, chr(10) ORDER BY k) AS content FROM g GROUP BY r
), m AS (
  SELECT r, n, min(r) OVER (PARTITION BY content) AS class FROM a
), s AS (
  SELECT g.r AS class, k, n FROM g JOIN m USING (r) WHERE m.r = m.class
), linked AS (
  SELECT x.class AS a, y.class AS b FROM s x JOIN s y ON x.k = y.k AND x.class < y.class
  GROUP BY x.class, y.class, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), edge AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reach AS (
  SELECT DISTINCT class AS a, class AS b FROM m UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a
), least AS (
  SELECT class, min(doc_id) AS doc_id FROM m JOIN d USING (r) GROUP BY class
), component AS (
  SELECT reach.a AS class, min(least.doc_id) AS id FROM reach JOIN least ON least.class = reach.b GROUP BY reach.a
)
SELECT d.doc_id, coalesce(m.n, 0)::BIGINT AS n_shingles, coalesce(component.id, d.doc_id) AS component_id
FROM d LEFT JOIN m USING (r) LEFT JOIN component USING (class)
"""

RULES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), s AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d
), t AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM s
), g AS (
  SELECT r, p, word, CASE WHEN count(*) OVER x = 5 THEN string_agg(word, ' ') OVER x END AS k
  FROM t WINDOW x AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
), m AS (
  SELECT *, k IS NOT NULL AND count(*) OVER (PARTITION BY r, k) > 1 AS again FROM g
), c AS (
  SELECT r, word, bool_or(again) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside FROM m
), words AS (
  SELECT r, count(*) AS n, sum(length(word)) AS chars, count(*) FILTER (inside) AS n_repeat FROM c GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), counted AS (
  SELECT r, doc_id, lang, source, coalesce(n, 0)::BIGINT AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN words USING (r) LEFT JOIN lines USING (r)
), based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
), rated AS (  -- slack: what is always allowed; two: low values are judged too
  SELECT r, lang, source, 'symbol' AS rate, 60 AS slack, false AS two, least(2000, 1000 * n_symbols // greatest(word_chars, 1)) AS v FROM based
  UNION ALL SELECT r, lang, source, 'repeat', 200, false, least(2000, 1000 * n_repeat_words // greatest(n_words, 1)) FROM based
  UNION ALL SELECT r, lang, source, 'line', 60, false, least(2000, 1000 * n_dup_lines // greatest(n_words, 1)) FROM based
  UNION ALL SELECT r, lang, source, 'length', 20, true, least(2000, 10 * word_chars // greatest(n_words, 1)) FROM based
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, rate ORDER BY v) AS o_at, count(*) OVER (PARTITION BY lang, source, rate) AS o_n,
         row_number() OVER (PARTITION BY lang, rate ORDER BY v) AS l_at, count(*) OVER (PARTITION BY lang, rate) AS l_n,
         row_number() OVER (PARTITION BY rate ORDER BY v) AS a_at, count(*) OVER (PARTITION BY rate) AS a_n FROM rated
), quartered AS (  -- of a source, its language, and all
  SELECT *, min(v) FILTER (4 * o_at >= o_n) OVER o AS o1, min(v) FILTER (4 * o_at >= 3 * o_n) OVER o AS o3,
         min(v) FILTER (4 * l_at >= l_n) OVER l AS l1, min(v) FILTER (4 * l_at >= 3 * l_n) OVER l AS l3,
         min(v) FILTER (4 * a_at >= a_n) OVER a AS a1, min(v) FILTER (4 * a_at >= 3 * a_n) OVER a AS a3
  FROM placed WINDOW o AS (PARTITION BY lang, source, rate), l AS (PARTITION BY lang, rate), a AS (PARTITION BY rate)
), drawn AS (
  SELECT r, v, slack, two, (o_n * o1 + 50 * ((l_n * l1 + 50 * a1) / (l_n + 50))) / (o_n + 50) AS q1,
         (o_n * o3 + 50 * ((l_n * l3 + 50 * a3) / (l_n + 50))) / (o_n + 50) AS q3 FROM quartered
), verdict AS (
  SELECT r, bool_and(v <= q3 + 3 * (q3 - q1) + slack AND (NOT two OR v >= q1 - 3 * (q3 - q1) - slack)) AS ok FROM drawn GROUP BY r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ok AND NOT base_failed AS kept
FROM based JOIN verdict USING (r)
"""
