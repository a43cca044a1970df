"""DuckDB SQL of the queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op1_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), s AS (
  SELECT doc_id, text,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), w AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS p, words FROM s WHERE len(words) >= 3
), w3 AS (
  SELECT doc_id, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS x FROM w
), twice AS (
  SELECT doc_id, p FROM w3 QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1
), rep AS (
  SELECT doc_id, count(DISTINCT p + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id
), line AS (
  SELECT doc_id, l, length(l) AS chars, i,
         row_number() OVER (PARTITION BY doc_id, l ORDER BY i) AS copy,
         len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n,
         lower(l) AS low
  FROM (SELECT doc_id, unnest(lines) AS l, unnest(range(len(lines))) AS i FROM s)
), counted AS (
  SELECT *,
         len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w IN ('|', '»', '›', '>', '•', '·'))) AS separators,
         len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: regexp_matches(w, '[!?]["''”’»)\]]*$'))) AS shouts,
         len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: regexp_matches(w, '[#*$%&|<>][.,;:!?]*$'))) AS symbols,
         regexp_matches(low, 'licensed under|all rights reserved|terms of use|terms of service|privacy policy|cookie policy|use of cookies|enable javascript|lorem ipsum|sign up for our newsletter|click here to|general public license|mit license|copyright \(c\)') AS phrase
  FROM line
), verdict AS (
  SELECT *,
         copy = 1
         AND (regexp_matches(l, '[.!?…。！？:;؟۔؛।॥։።။។།]["''”’»)\]]*[\x20\x09-\x0D]*$') OR n >= 20 OR regexp_matches(l, '[\x{0E00}-\x{0EFF}]'))
         AND NOT shouts * 100 > n * 30
         AND NOT symbols * 100 > n * 30
         AND NOT (separators >= 3 AND separators * 100 > n * 20)
         AND NOT (phrase AND n <= 25) AS good
  FROM counted
), per AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (copy > 1) AS n_dup, count(*) FILTER (NOT good) AS n_removed,
         sum(chars) AS n_chars, coalesce(sum(chars) FILTER (NOT good), 0) AS lost
  FROM verdict GROUP BY doc_id
), base AS (
  SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
         CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed_lines,
         CAST(coalesce(n_chars, 0) AS BIGINT) AS n_line_chars,
         CAST(coalesce(lost, 0) AS BIGINT) AS n_lost_chars
  FROM s LEFT JOIN rep USING (doc_id) LEFT JOIN per ON per.doc_id = s.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost_chars * 100 <= n_line_chars * 50 AS kept,
       n_lines, n_removed_lines, n_line_chars, n_lost_chars
FROM base
"""

SQL["op13_line_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d
), k AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM l
), f AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10
), m AS (
  SELECT k.*, f.key IS NOT NULL AS dropped FROM k LEFT JOIN f ON f.key = k.key
), g AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '') AS kept
  FROM m GROUP BY r
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256
FROM d JOIN g USING (r)
"""

SQL["op12_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         doc_id > min(doc_id) OVER (PARTITION BY text) AS copy
  FROM d
), m AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN copy THEN 16 ELSE 0 END AS mask
  FROM w
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(letter, bit)
), o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), s AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
  FROM o, range(1, 6) AS r(step)
), g AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM g
"""
