"""DuckDB SQL for the same rows, where SQL can say them."""

CHAT = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *,
    replace(replace(replace(text, '\', '\\'), '### ', '\h'), '</turn>', '\e') AS body,
    replace(replace(replace(replace(role, '\', '\\'), '### ', '\h'), '</turn>', '\e'), ':', '\c') AS head
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ') + length(head) + length(': ') + length(body) + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), reached AS (
  SELECT vec_id AS id, vec_id AS m FROM embeddings
  UNION SELECT l.b, r.m FROM reached r JOIN links l ON l.a = r.id
), named AS (SELECT id, min(m) AS component_id FROM reached GROUP BY id)
SELECT n.id AS vec_id, (SELECT count(*) FROM links l WHERE l.a = n.id) AS n_links, component_id, n.id = component_id AS kept FROM named n
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, k, k + least(10, len(w)) - 1), ' ') AS x
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS k FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d, sizes WHERE len(w) >= n)
), found AS (SELECT doc_id, item_id, p.n, k FROM places p JOIN windows USING (n, x)),
hit AS (SELECT doc_id, count(DISTINCT position) AS n_hit FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS position FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# crc32 by its table of 256 entries, which the polynomial gives
SPELLING = r"""
WITH RECURSIVE crc_bits AS (
  SELECT i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS entries FROM crc_bits WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents WHERE text IS NOT NULL
), seen AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(
    list_transform(regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'), lambda x: CAST('0x' || x AS BIGINT)),
    lambda acc, b: xor(acc >> 8, entries[CAST(xor(acc, b) & 255 AS INT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM seen, crc_table
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n
    FROM hashed
  ) GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3
), lacking AS (
  SELECT word, n, 0 AS k, word AS rest FROM words
  UNION ALL SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
), near AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM lacking a JOIN lacking b ON a.rest = b.rest AND a.word <> b.word
  WHERE a.k = b.k OR a.k = 0 OR b.k = 0
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS n, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM near GROUP BY word
), led AS (
  SELECT w.word, CASE WHEN b.form_n >= 2 * w.n THEN b.form END AS form, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN b.form_n >= 2 * w.n THEN b.form_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain AS (
  SELECT word, form AS root FROM led WHERE form IS NOT NULL
  UNION ALL SELECT c.word, l.form FROM chain c JOIN led l ON l.word = c.root WHERE l.form IS NOT NULL
), last AS (SELECT c.word, c.root FROM chain c JOIN led l ON l.word = c.root WHERE l.form IS NULL)
SELECT l.word, l.form, coalesce(r.root, l.word) AS root, l.n, l.n_near, l.form_n FROM led l LEFT JOIN last r USING (word)
"""

AUDIT = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), tests AS (
  SELECT doc_id, part, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, length(t) AS size, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS capitals,
    regexp_matches(t, '[#$%&*|]') AS d, coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS e FROM docs
), good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1), bad AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
failing AS (
  SELECT part, doc_id IN (SELECT doc_id FROM good) AS good, doc_id IN (SELECT doc_id FROM bad) AS toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * capitals > 2 * size, d, e] AS fails FROM tests
), kinds AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY part, fails),
orders AS (
  SELECT '' AS o
  UNION ALL SELECT o || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE NOT contains(o, f)
), steps AS (SELECT o, k, substr(o, k, 1) AS f, substr(o, 1, k - 1) AS before FROM orders, range(1, 6) t(k) WHERE length(o) = 5),
tested AS (
  SELECT part, o, k, f, n, good, toxic, fails[ascii(f) - 64] AS own,
    len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: contains(before, x) AND fails[ascii(x) - 64])) > 0 AS gone,
    len(list_filter(fails, lambda x: x)) AS n_failed
  FROM kinds, steps
), counted AS (
  SELECT part, o, k, f, sum(n) FILTER (NOT gone AND NOT own) AS kept, sum(n) FILTER (NOT gone AND own) AS removed,
    sum(n) FILTER (gone AND own) AS redundant, sum(n) FILTER (own AND n_failed = 1) AS unique_fails,
    sum(good) FILTER (NOT gone AND own) AS good_lost, sum(toxic) FILTER (NOT gone AND own) AS toxic_lost
  FROM tested GROUP BY ALL
)
SELECT part, o AS filter_order, CAST(k AS INT) AS step,
  CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
