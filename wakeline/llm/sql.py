"""SQL for DuckDB of the operators that it can express, written from their contracts."""

#: A-Z to lower case and no other letter.
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP13 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
places AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
met AS (SELECT r, p.s, p.n, item_id FROM places p JOIN windows USING (n, phrase)),
hit AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS pos FROM met) GROUP BY r),
owner AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), '') AS id FROM met) GROUP BY r),
word AS (SELECT r, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos FROM docs),
term AS (SELECT DISTINCT item_id, unnest(w) AS term FROM items),
counts AS (SELECT term, count(*) AS n FROM word GROUP BY term),
rare AS (
  SELECT item_id, term, count(*) OVER (PARTITION BY item_id) AS size
  FROM (SELECT item_id, t.term, row_number() OVER (PARTITION BY item_id ORDER BY coalesce(n, 0), t.term) AS k
        FROM term t LEFT JOIN counts USING (term)) WHERE k <= 6),
place AS (SELECT item_id, r, pos, word.term, size FROM rare JOIN word USING (term)),
near AS (
  SELECT r, count(DISTINCT coalesce(CAST(item_id AS VARCHAR), '')) AS n_near
  FROM (SELECT a.r, a.item_id FROM place a JOIN place b
          ON a.r = b.r AND a.item_id IS NOT DISTINCT FROM b.item_id AND b.pos BETWEEN a.pos AND a.pos + 29
        GROUP BY a.r, a.item_id, a.pos, a.size HAVING count(DISTINCT b.term) = a.size) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM docs LEFT JOIN hit USING (r) LEFT JOIN owner USING (r) LEFT JOIN near USING (r)
"""

#: White space of the contract: blanks and the control characters 9 to 13.
_BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

OP12 = rf"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
                 lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END) AS v
        FROM range(256) g(i))),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS name
  FROM conversations),
fated AS (
  SELECT given.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
             list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT))),
             lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), CAST(4294967295 AS BIGINT)) % 20 AS fate
  FROM given, crc),
harmed AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE fate WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM fated WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         rtrim(text, {_BLANKS}) = '' AS blank FROM harmed),
judged AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
         right(rtrim(text, {_BLANKS}), 1) NOT IN ('.', '!', '?') AS cut,
         CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS c FROM placed),
turns AS (
  SELECT *, blank OR duplicate AS lost, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM judged),
step AS (SELECT * FROM (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) v(q, nxt)),
ins AS (
  SELECT q, q AS q2, 0 AS k, CAST([] AS VARCHAR[]) AS said FROM step
  UNION ALL SELECT q, nxt, 1, [CASE nxt WHEN 2 THEN 'user:' ELSE 'assistant:' END] FROM step
  UNION ALL SELECT a.q, b.nxt, 2, [CASE a.nxt WHEN 2 THEN 'user:' ELSE 'assistant:' END,
                                  CASE b.nxt WHEN 2 THEN 'user:' ELSE 'assistant:' END]
  FROM step a JOIN step b ON b.q = a.nxt),
keep AS (SELECT * FROM (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)) v(c, q, q2)),
edit AS (
  SELECT 'D' AS e, t.conv_id, i, s.q, s.q AS q2, 3 AS cost, CAST([] AS VARCHAR[]) AS said FROM turns t, step s
  UNION ALL SELECT 'K', t.conv_id, i, k.q, k.q2, CAST(cut AS INT), [role || ':' || text] FROM turns t JOIN keep k USING (c) WHERE NOT lost
  UNION ALL SELECT 'R', t.conv_id, i, s.q, s.nxt, 2 + CAST(cut AS INT),
                   [CASE s.nxt WHEN 2 THEN 'user:' ELSE 'assistant:' END || text] FROM turns t, step s WHERE NOT lost),
path AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'said': CAST([] AS VARCHAR[])}} AS best
  FROM turns GROUP BY conv_id
  UNION ALL
  SELECT p.conv_id, p.i + 1, e.q2, min({{'cost': p.best.cost + 2 * n.k + e.cost, 'audit': p.best.audit || repeat('I', n.k) || e.e,
         'said': list_concat(list_concat(p.best.said, n.said), e.said)}})
  FROM path p JOIN ins n ON n.q = p.q
       JOIN edit e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 AND e.q = n.q2
  GROUP BY p.conv_id, p.i, e.q2),
size AS (
  SELECT conv_id, max(i) AS n, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
         count(*) FILTER (WHERE cut AND NOT lost) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM turns GROUP BY conv_id),
finished AS (
  SELECT s.conv_id, gaps, blank, duplicate, truncated, illegal,
         min({{'cost': p.best.cost + 2 * n.k, 'audit': p.best.audit || repeat('I', n.k), 'said': list_concat(p.best.said, n.said)}}) AS best
  FROM size s JOIN path p ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = s.n
       JOIN ins n ON n.q = p.q AND n.q2 IN (0, 3)
  GROUP BY ALL)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(f.best.cost, 0) AS BIGINT) AS cost,
       coalesce(f.best.audit, '') AS audit, sha256(coalesce(array_to_string(f.best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN finished f ON o.conv_id IS NOT DISTINCT FROM f.conv_id
"""

OP11 = rf"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\n\x0B\f\r]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, {_LOWER.format("coalesce(text, '')")} AS t FROM documents)),
words AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM words, range(1, 5) g(k) WHERE len(w) >= k)),
f AS (SELECT lang, CAST(k AS INT) AS k, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT lang, k, phrase, a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS c FROM f WHERE k > 1)),
scored AS (
  SELECT x.lang, x.k, x.phrase, x.a, x.c, h.a AS l, t.a AS r,
         CAST(2000000 * CAST(x.a AS HUGEINT) // (CAST(h.a AS HUGEINT) + t.a) AS BIGINT) AS score
  FROM cuts x JOIN f h ON h.lang = x.lang AND h.phrase = x.head JOIN f t ON t.lang = x.lang AND t.phrase = x.tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
parts AS (
  SELECT lang, a, array_to_string(w[s:s + j - 1], ' ') AS part
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS j FROM f WHERE k > 2))),
longer AS (SELECT lang, part, max(a) AS most FROM parts GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.part = b.phrase
  WHERE most IS NULL OR 100 * most < 80 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
