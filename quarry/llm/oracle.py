"""DuckDB SQL of the queries that SQL can express."""

SQL: dict[str, str] = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL["op5_block_naming_dedup"] = r"""WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents
), g AS (
  SELECT doc_id, body, first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY body) AS group_size FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g"""

SQL["op8_quality_cascade"] = rf"""WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) > 2) x
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS n FROM win) y WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) z GROUP BY doc_id
), m AS (
  SELECT t.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    length(regexp_replace(text, '\P{{L}}+', '', 'g')) AS letters
  FROM t LEFT JOIN covered c ON t.doc_id = c.doc_id
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT (base_failed OR word_chars > 40 * n_words OR word_chars < 2 * n_words OR 2 * n_symbols > 3 * n_words
    OR (n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines) OR 2 * letters < word_chars) AS kept
FROM f"""

SQL["op9_fair_source_mixing"] = rf"""WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5('mix-1:' || CAST(doc_id AS VARCHAR)) AS draw FROM documents
), s AS (
  SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, sum(source_size) OVER () AS total
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source) a
), r AS (  -- sources in the order in which a rising share stops them
  SELECT *, 3.0 * source_size / weight AS stop,
    coalesce(sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open
  FROM s
), share AS (
  SELECT arg_min(CAST(total - held AS DOUBLE) / CAST(open AS DOUBLE), stop) AS share FROM r WHERE CAST(total - held AS DOUBLE) / CAST(open AS DOUBLE) < stop
), g AS (
  SELECT source, source_size, total, CASE WHEN 3 * source_size <= weight * share THEN CAST(3 * source_size AS DOUBLE) ELSE weight * share END AS target
  FROM s, share
), q AS (
  SELECT d.*, g.source_size, g.target, g.total, sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id ROWS UNBOUNDED PRECEDING) AS cum
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), c AS (
  SELECT *, CAST(turn * source_size + cum AS DOUBLE) / target AS finish FROM q, (SELECT unnest([0, 1, 2]) AS turn) t
  WHERE size > 0 AND turn * source_size + cum - size < target
), a AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, draw, doc_id, size ROWS UNBOUNDED PRECEDING) AS all_words FROM c
), k AS (SELECT doc_id, count(*) AS copies FROM a WHERE all_words <= total GROUP BY doc_id)
SELECT q.doc_id, size, source_size, target, CAST(coalesce(copies, 0) * size AS BIGINT) AS taken FROM q LEFT JOIN k ON q.doc_id = k.doc_id"""

SQL["op12_benchmark_decontamination"] = r"""WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS w
  FROM documents
), iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS body
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM iw WHERE len(w) > 0) x
), sizes AS (SELECT DISTINCT k FROM win), pos AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS body
  FROM (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM dw, sizes WHERE len(w) >= k) x
), hit AS (SELECT DISTINCT r, i, k, body FROM pos SEMI JOIN win USING (k, body)), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) y GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hit JOIN win USING (k, body) WHERE item IS NOT NULL) z GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

SQL["op13_filter_interactions"] = r"""WITH t AS (
  SELECT d.doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, min(d.doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents d LEFT JOIN (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id
), f AS (
  SELECT part, good, toxic, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first_id, false)] AS fails FROM t
), c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails), x AS (SELECT unnest(range(1, 6)) AS v), p AS (
  SELECT [a.v, b.v, c.v, d.v, e.v] AS o FROM x a, x b, x c, x d, x e
  WHERE a.v NOT IN (b.v, c.v, d.v, e.v) AND b.v NOT IN (c.v, d.v, e.v) AND c.v NOT IN (d.v, e.v) AND d.v <> e.v
), s AS (
  SELECT array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, v AS step, o[v] AS own, o[1:v - 1] AS earlier FROM p, x
), m AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS fail, len(list_filter(earlier, lambda i: fails[i])) > 0 AS gone,
    len(list_filter(fails, lambda b: b)) AS n_fails FROM c, s
), g AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT fail THEN n ELSE 0 END) AS kept, sum(CASE WHEN fail AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fail AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fail AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fail AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fail AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM m GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM g"""
