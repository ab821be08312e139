"""DuckDB SQL of the queries that SQL can express, written from their definitions."""

OP1 = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT *, list_transform(range(1, greatest(len(words) - 6, 1)), lambda i: array_to_string(words[i:i+7], ' ')) AS grams FROM w),
m AS (SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(len(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines, grams FROM g),
p AS (SELECT doc_id, unnest(grams) AS gram, generate_subscripts(grams, 1) AS pos FROM m),
d AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM p) WHERE n > 1),
c AS (SELECT doc_id, CAST(count(DISTINCT pos + k) AS BIGINT) AS n_repeat_words FROM d, range(0, 8) AS r(k) GROUP BY doc_id),
r AS (SELECT m.* EXCLUDE (grams), coalesce(n_repeat_words, 0) AS n_repeat_words FROM m LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM r),
a AS (SELECT *, base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines
        OR word_chars < 2 * n_words OR word_chars > 12 * n_words AS fails FROM f),
h AS (SELECT source, count(*) AS n, count(*) FILTER (fails) AS bad FROM a WHERE source IS NOT NULL GROUP BY source),
u AS (SELECT sum(bad) / sum(n) AS mean, sum(n) AS total, sum(n * n) AS squares, count(*) AS hosts FROM h),
v AS (SELECT any_value(mean) AS mean, least(1, (sum(n * (bad / n - mean) ** 2) / nullif(any_value(mean * (1 - mean)), 0) - any_value(hosts - 1))
        / nullif(any_value(total - squares / total - (hosts - 1)), 0)) AS inside FROM h, u),
s AS (SELECT mean, CASE WHEN inside > 0 THEN 1 / inside - 1 END AS weight FROM v),
j AS (SELECT source, CASE WHEN weight IS NULL THEN mean ELSE (bad + weight * mean) / (n + weight) END >= 0.5 AS host_bad FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (coalesce(host_bad, false) AND fails) AS kept
FROM a LEFT JOIN j USING (source)
"""

OP5 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP10 = """
WITH p AS (SELECT conv_id, conv_id // 2 AS pair_id, CASE WHEN conv_id % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place, role, text
           FROM conversations WHERE conv_id IS NOT NULL),
d AS (SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.place, b.place) AS place,
        a.conv_id IS NOT NULL AND b.conv_id IS NOT NULL AND a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text AS same
      FROM (SELECT * FROM p WHERE side = 'chosen') a FULL JOIN (SELECT * FROM p WHERE side = 'rejected') b
        ON a.pair_id = b.pair_id AND a.place = b.place),
n AS (SELECT pair_id, coalesce(min(place) FILTER (NOT same), max(place) + 1) AS n_prompt FROM d GROUP BY pair_id)
SELECT pair_id, CASE WHEN place < n_prompt THEN 'prompt' ELSE side END AS section, CAST(place AS BIGINT) AS place, role,
       '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS rendered,
       place >= n_prompt AND coalesce(role = 'assistant', false) AS learn, CAST(n_prompt AS BIGINT) AS n_prompt
FROM p JOIN n USING (pair_id) WHERE place >= n_prompt OR side = 'chosen'
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT r, i, n, win FROM dw WHERE EXISTS (SELECT 1 FROM bw WHERE bw.n = dw.n AND bw.win = dw.win)),
c AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM h, range(0, 10) AS s(k) WHERE k < n GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM h JOIN bw USING (n, win) WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""

# crc32 as lists: the byte table from its polynomial, then a fold over the bytes of each text.
OP13 = r"""
WITH RECURSIVE k AS (SELECT list(list_reduce(list_prepend(CAST(x AS BIGINT), range(0, 8)),
              lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY x) AS t FROM range(0, 256) AS g(x)),
o AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY 1, 2),
x AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hx FROM o),
b AS (SELECT run, n, list_transform(range(0, len(hx) // 2), lambda i: CAST(16 * (strpos('0123456789ABCDEF', hx[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', hx[2 * i + 2]) - 1 AS BIGINT)) AS bytes FROM x),
h AS (SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
              lambda c, y: xor(c // 256, list_extract(t, CAST(xor(c % 256, y) AS BIGINT) + 1))), 4294967295) AS h FROM b, k),
v AS (SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY 1),
w AS (SELECT word, n FROM v WHERE length(word) >= 7 AND n >= 2),
l AS (SELECT word, n, p, word[1:p - 1] || word[p + 1:] AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM w)),
e AS (SELECT a.word, b.word AS near, b.n AS near_n FROM l a JOIN l b ON a.less = b.less AND a.p = b.p AND a.word <> b.word
      UNION SELECT l.word, w.word, w.n FROM l JOIN w ON l.less = w.word
      UNION SELECT w.word, l.word, l.n FROM l JOIN w ON l.less = w.word),
g AS (SELECT word, count(*) AS n_near, max(near_n) AS near_n FROM e GROUP BY word),
m AS (SELECT g.word, n_near, g.near_n, min(near) AS near FROM g JOIN e ON g.word = e.word AND g.near_n = e.near_n GROUP BY ALL),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m.near_n >= 10 * w.n THEN near END AS form, CASE WHEN m.near_n >= 10 * w.n THEN m.near_n END AS form_n
      FROM w LEFT JOIN m USING (word)),
s(word, root) AS (SELECT word, word FROM f UNION ALL SELECT s.word, f.form FROM s JOIN f ON s.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n FROM f JOIN s ON f.word = s.word JOIN f AS z ON s.root = z.word AND z.form IS NULL
"""

ORACLES = {"op10_preference": OP10, "op12_decontamination": OP12, "op13_spelling": OP13, "op1_quality_rules": OP1, "op5_exact_topk": OP5}
