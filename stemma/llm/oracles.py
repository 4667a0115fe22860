"""The same results as SQL, for the queries whose operators SQL can express on whole tables."""

#: Windows of every place of every document against the windows of the items.
DECONTAMINATION = r"""WITH low AS (SELECT doc_id, row_number() OVER () AS row, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
doc AS (SELECT doc_id, row, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
item AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(ws), 13) AS size, ws[i : i + least(len(ws), 13) - 1] AS w FROM item, range(1, 100000) t(i) WHERE len(ws) > 0 AND i <= len(ws) - least(len(ws), 13) + 1),
sizes AS (SELECT DISTINCT size FROM win),
place AS (SELECT row, unnest(range(1, len(ws) + 1)) AS i, ws FROM doc),
found AS (SELECT row, i, p.size, item_id FROM (SELECT row, i, size, ws[i : i + size - 1] AS w FROM place, sizes WHERE i + size - 1 <= len(ws)) p JOIN win ON p.size = win.size AND p.w = win.w),
hit AS (SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS j FROM found) GROUP BY row),
held AS (SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY encode(id)) AS ids FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY row)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated FROM doc LEFT JOIN hit USING (row) LEFT JOIN held USING (row)"""

#: crc32 by its table of 256 steps; near words by leaving out one character of one or of both.
SPELLING = """WITH RECURSIVE steps AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(CAST(b AS BIGINT), range(8)), lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END))) AS step),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) WHERE length(run) >= 6 GROUP BY ALL),
keyed AS (SELECT run, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key FROM runs),
bytes AS (SELECT run, n, flatten(list_transform(string_split(key, ''), lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [CAST(192 + (ord(c) >> 6) AS BIGINT), CAST(128 + (ord(c) & 63) AS BIGINT)] END)) AS b FROM keyed),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, step[1 + (xor(c, x) & 255)])), 4294967295) AS h FROM bytes, steps),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, 2 + h % length(run)) ELSE run END AS word, n FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS part FROM words, range(1, 10000) t(i) WHERE i <= length(word)),
near AS (SELECT DISTINCT * FROM (
  SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.part = b.word UNION ALL SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.part = b.word)),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, encode(near)) AS form, max(n) AS form_n FROM near GROUP BY word),
told AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root, form AS next FROM told UNION ALL SELECT walk.word, walk.next, told.form FROM walk JOIN told ON told.word = walk.next)
SELECT told.*, root FROM told JOIN walk USING (word) WHERE next IS NULL"""

#: All scores, ranked.
TOPK = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
q AS (SELECT DISTINCT vec_id, x FROM v WHERE vec_id % 100 = 0),
s AS (SELECT q.vec_id AS query_id, q.x AS word, v.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.x, v.x), lambda z: coalesce(z[1] * z[2], 0))), 0) AS BIGINT) AS score FROM q JOIN v ON v.vec_id IS DISTINCT FROM q.vec_id),
r AS (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id, word ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 10"""
