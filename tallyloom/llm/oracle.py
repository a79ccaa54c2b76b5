"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

OP3 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT row_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), repeated AS (
  SELECT row_id, i FROM (
    SELECT *, count(*) OVER (PARTITION BY row_id, a, b, c) AS n FROM windows
  ) WHERE n > 1
), covered AS (
  SELECT row_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY row_id
), m AS (
  SELECT doc_id, text, words, lines,
    len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (row_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 2 * n_symbols > n_words
    OR 10 * n_dup_lines > 3 * len(lines)
    OR 2 * (length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g'))) > word_chars
    OR 10 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < 6 * n_words
    OR 20 * list_sum(list_transform(
      range(0, greatest(len(words) - 1, 0) // 1000 + 1),
      lambda i: len(list_distinct(words[i * 1000 + 1 : i * 1000 + 1000]))
    )) < n_words
  ) AS kept
FROM m
"""

OP5 = r"""
WITH d AS (
  SELECT doc_id,
    CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS source_key,
    len(list_filter(
      regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''
    ))::BIGINT AS size,
    md5('5:' || coalesce(doc_id::VARCHAR, 'null')) AS place
  FROM documents
), s AS (
  SELECT source_key, sum(size)::BIGINT AS source_size FROM d GROUP BY source_key
), weighed AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source_key) - 1) % 3 + 1)::INT]::BIGINT AS weight,
    2 * source_size AS room, (sum(source_size) OVER ())::BIGINT * 150 AS shared
  FROM s
), filling AS (
  SELECT *,
    coalesce(sum(room) OVER (ORDER BY room / weight, source_key
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER (ORDER BY room / weight, source_key
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS claims
  FROM weighed
), filled AS (
  SELECT *, room * 100 * claims <= (shared - used * 100) * weight AS is_full FROM filling
), left_over AS (
  SELECT *, sum(CASE WHEN is_full THEN room ELSE 0 END) OVER () AS all_used,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS all_claims
  FROM filled
), targets AS (
  SELECT source_key, source_size,
    CASE WHEN is_full THEN room::DOUBLE
      ELSE (weight * (shared - all_used * 100))::DOUBLE / (all_claims * 100)::DOUBLE END AS target
  FROM left_over
), rated AS (
  SELECT d.*, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size * 1073741824)::HUGEINT ELSE 0 END AS units,
    ('0x' || substr(md5('5:' || source_key), 1, 7))::BIGINT * 4 AS start
  FROM d JOIN targets USING (source_key)
), placed AS (
  SELECT *, coalesce(sum(units) OVER (PARTITION BY source_key ORDER BY size, place, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS front
  FROM rated
)
SELECT doc_id, size, source_size, target,
  (size * ((front + units + start) // 1073741824 - (front + start) // 1073741824))::BIGINT AS taken
FROM placed
"""

OP7 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(doc_id, 9223372036854775807) AS did, doc_id,
    string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), l AS (
  SELECT row_id, did, i, lines[i] AS line,
    translate(
      trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
    ) AS key
  FROM (SELECT row_id, did, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
), first_doc AS (
  SELECT key, min(did) AS first_did FROM l WHERE length(key) >= 10 GROUP BY key
), kept AS (
  SELECT row_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n
  FROM l LEFT JOIN first_doc USING (key)
  WHERE first_did IS NULL OR first_did = did GROUP BY row_id
)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row_id)
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), sizes AS (
  SELECT row_id, doc_id, len(terms)::BIGINT AS n FROM d
), whole AS (
  SELECT count(*) FILTER (n > 0) AS documents, sum(n)::BIGINT AS length FROM sizes
), item_terms AS (
  SELECT item_no, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS item_no, item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
  ) GROUP BY ALL
), counts AS (
  SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), whole
), scored AS (
  SELECT item_no, item_id, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * documents) // length))))::BIGINT
      AS score
  FROM item_terms JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (row_id), whole
  GROUP BY item_no, item_id, row_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank,
    doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op3_quality_rules": OP3,
    "op5_mixing": OP5,
    "op7_line_dedup": OP7,
    "op11_lexical_search": OP11,
}
