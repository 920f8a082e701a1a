"""Plain DuckDB SQL giving the same rows as the query of the same name, where SQL can express it."""

ORACLE: dict[str, str] = {}

ORACLE["op2_decontaminate"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM sized, unnest(range(1, len(w) - n + 2)) AS u(i)),
placed AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM docs, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) AS u(i)),
hits AS (SELECT DISTINCT r, i, n, item_id FROM placed JOIN windows USING (n, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(p) GROUP BY r),
found AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

QUALITY = r"""
base AS (
  SELECT row_number() OVER () AS r, *, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT r, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g FROM base, unnest(range(1, len(w) - 1)) AS u(i)),
again AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM again, unnest(range(i, i + 3)) AS u(p) GROUP BY r),
measured AS (
  SELECT base.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM base LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 10 * word_chars THEN 4 ELSE 0 END
    + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 30 * n_words THEN 32 ELSE 0 END
    AS failures
  FROM measured)
"""

ORACLE["op3_quality_rules"] = f"""
WITH {QUALITY}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed,
  failures = 0 AS kept, CAST(failures AS BIGINT) AS failures, n_lines
FROM judged
"""

LINES = r"""
pages AS (
  SELECT row_number() OVER () AS r, doc_id, text, source, coalesce('=' || source, '') AS host FROM documents),
split_lines AS (
  SELECT r, host, generate_subscripts(l, 1) AS p, unnest(l) AS line
  FROM (SELECT r, host, string_split(text, chr(10)) AS l FROM pages)),
keyed AS (
  SELECT *, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS k FROM split_lines),
totals AS (SELECT host, count(*) AS n FROM pages GROUP BY host),
dropped AS (
  SELECT host, k FROM (SELECT host, k, count(DISTINCT r) AS c FROM keyed WHERE k <> '' GROUP BY host, k)
  JOIN totals USING (host) WHERE c >= 5 AND c > n * 0.02),
marked AS (SELECT keyed.*, dropped.k IS NOT NULL AS gone FROM keyed LEFT JOIN dropped USING (host, k)),
rebuilt AS (
  SELECT r, coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '') AS kept, count(*) AS n,
    count(*) FILTER (gone) AS d
  FROM marked GROUP BY r)
"""

ORACLE["op7_line_dedup"] = f"""
WITH {LINES}
SELECT doc_id, source, kept AS text, CAST(coalesce(n, 0) AS BIGINT) AS n_lines, CAST(coalesce(d, 0) AS BIGINT) AS n_dropped
FROM pages LEFT JOIN rebuilt USING (r)
"""

ORACLE["op9_substring_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS p, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
cut AS (
  SELECT doc_id, p, generate_subscripts(c, 1) AS q, unnest(c) AS piece FROM (
    SELECT doc_id, p, string_split(
      regexp_replace(line, '([.!?]+[\x20\x09\x0B-\x0D]+)', '\1' || chr(10), 'g'), chr(10)) AS c FROM lines)),
placed AS (
  SELECT *, regexp_extract_all(piece, '[^\x20\x09-\x0D]+') AS w, p - 1 + coalesce(sum(length(piece)) OVER (
      PARTITION BY doc_id ORDER BY p, q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM cut),
units AS (
  SELECT doc_id, p, q, translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM placed WHERE len(w) >= 8),
ranked AS (SELECT doc_id, p, q, row_number() OVER (PARTITION BY k ORDER BY doc_id, p, q) AS n FROM units),
met AS (
  SELECT placed.*, n IS NOT NULL AS unit, coalesce(n, 1) > 1 AS again FROM placed LEFT JOIN ranked USING (doc_id, p, q)),
stretched AS (
  SELECT *, count(*) FILTER (unit AND NOT again) OVER (PARTITION BY doc_id ORDER BY p, q) AS stretch FROM met),
judged AS (
  SELECT *, again AND sum(len(w)) FILTER (again) OVER (PARTITION BY doc_id, stretch) >= 20 AS gone FROM stretched),
rejoined AS (
  SELECT doc_id, p, coalesce(string_agg(piece, '' ORDER BY q) FILTER (NOT gone), '') AS line,
    count(*) FILTER (unit) AS u, count(*) FILTER (gone) AS d,
    string_agg(CAST(start AS BIGINT) || ':' || CAST(start AS BIGINT) + length(piece), ',' ORDER BY q) FILTER (gone) AS spans
  FROM judged GROUP BY doc_id, p),
rebuilt AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (d = 0 OR line <> ''), '') AS kept,
    sum(u) AS u, sum(d) AS d, string_agg(spans, ',' ORDER BY p) AS spans
  FROM rejoined GROUP BY doc_id)
SELECT doc_id, kept AS text, CAST(coalesce(d, 0) AS BIGINT) AS n_removed, coalesce(spans, '') AS removed_spans,
  CAST(coalesce(u, 0) AS BIGINT) AS of_units
FROM documents LEFT JOIN rebuilt USING (doc_id)
"""

ORACLE["op12_importance"] = r"""
WITH bits AS (
  SELECT list(c ORDER BY b) AS table_of FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i:
      CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) AS r(b))),
texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 'b', NULL, NULL, text FROM benchmark),
worded AS (
  SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
used AS (SELECT kind, r, unnest(w) AS word FROM worded),
counted AS (SELECT word, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM used GROUP BY word),
bytes AS (
  SELECT word, s, t, hex(encode(word)) AS h FROM counted),
bucketed AS (
  SELECT word, s, t, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i:
      CAST(16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1 AS BIGINT))),
    lambda c, b: xor(c // 256, table_of[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, bits),
shares AS (
  SELECT bucket, CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t FROM bucketed GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM shares),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM shares, totals),
sums AS (
  SELECT r, sum(gain) AS total FROM used JOIN bucketed USING (word) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features,
    CASE WHEN len(w) = 0 THEN 0 ELSE CAST(floor(CAST(total AS DOUBLE) / len(w)) AS BIGINT) END AS weight,
    CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) AS h
  FROM worded LEFT JOIN sums USING (r) WHERE kind = 'd'),
judged AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score, n_features >= 20 AS fit
  FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id, n_features) AS place,
    count(*) FILTER (fit) OVER () AS n FROM judged)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""

ORACLE["op13_filter_audit"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
known AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM docs LEFT JOIN known USING (doc_id)),
counters AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, i AS step, filter_order[i] AS f, CAST(pow(2, ascii(filter_order[i]) - 65) AS INT) AS own,
    CAST(list_sum(list_transform(range(1, i), lambda j: pow(2, ascii(filter_order[j]) - 65))) AS INT) AS prior
  FROM orders, range(1, 6) AS r(i)),
ran AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, f,
    sum(CASE WHEN mask & (own | coalesce(prior, 0)) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & own > 0 AND mask & coalesce(prior, 0) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own > 0 AND mask & coalesce(prior, 0) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & own > 0 AND mask & coalesce(prior, 0) = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & own > 0 AND mask & coalesce(prior, 0) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counters, steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM ran
"""
