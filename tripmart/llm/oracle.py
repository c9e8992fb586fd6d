"""DuckDB SQL of the operators that SQL can express, written from their definitions.

The others are held against brute force, exact round trips or held-out labels in ``tests/llm``: the
tokenizer (1, 4), model training (2, 5, 7), dependent rounding (3) and weighted samples (13). Projections, signatures and bands
only find candidates, so 9 and 10 are stated as what they must find: all pairs.
"""

from __future__ import annotations

OP8 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
r AS (SELECT *, row_number() OVER () AS rid FROM d),
windows AS (
  SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM r)),
repeated AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM windows),
covered AS (
  SELECT rid, count(DISTINCT i + j) AS n_repeat_words
  FROM (SELECT rid, i, unnest([0, 1, 2]) AS j FROM repeated WHERE n > 1) GROUP BY rid),
counted AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM r LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS f,
    count(*) FILTER (WHERE base_failed) / CAST(count(*) AS DOUBLE) AS rate
  FROM judged GROUP BY source),
prior AS (SELECT avg(rate) AS m, var_pop(rate) AS v FROM hosts),
strength AS (
  SELECT m, CASE WHEN v > 1e-9 THEN least(1e6, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1e6 END AS s FROM prior),
verdicts AS (SELECT source, (f + m * s) / (n + s) <= 0.5 AS host_kept FROM hosts, strength)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_kept AS kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""

OP6 = r"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, CAST(i AS BIGINT) AS value, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN value % 2 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(value ORDER BY byte) AS tbl FROM steps WHERE k = 8),
d AS (
  SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS hx, octet_length(encode(coalesce(text, ''))) AS bytes,
    CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
c AS (
  SELECT doc_id, source, h, CAST(bytes + 1 AS BIGINT) AS size,
    xor(list_reduce(list_transform(range(0, bytes), lambda i: CAST('0x' || substr(hx, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
      lambda a, b: xor(a >> 8, tbl[CAST((xor(a, b) & 255) + 1 AS BIGINT)]), CAST(4294967295 AS BIGINT)), 4294967295) AS text_crc32
  FROM d, crc),
f AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY h, doc_id, text_crc32, size) - 1)
    / CAST(2 * count(*) OVER (PARTITION BY source) AS DOUBLE) AS f FROM c),
p AS (
  SELECT *, row_number() OVER (ORDER BY f, source NULLS LAST, h, doc_id, text_crc32, size) - 1 AS pos,
    count(*) OVER () AS n FROM f)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(pos * 8 // n AS INTEGER) AS shard,
  CAST(pos - ((pos * 8 // n) * n + 7) // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""

OP9 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT reach.vec_id, links.y FROM reach JOIN links ON links.x = reach.other),
n AS (SELECT x, count(DISTINCT y) AS n_links FROM links GROUP BY x),
c AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN c ON c.vec_id = e.vec_id LEFT JOIN n ON n.x = e.vec_id
"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
counts AS (SELECT doc_id, s, count(*) AS n FROM shingles GROUP BY doc_id, s),
totals AS (SELECT doc_id, sum(n) AS total FROM counts GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.n, b.n)) AS n
  FROM counts a JOIN counts b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
near AS (
  SELECT x, y FROM common JOIN totals tx ON tx.doc_id = x JOIN totals ty ON ty.doc_id = y
  WHERE CAST(n AS DOUBLE) / (tx.total + ty.total - n) >= 0.8
  UNION ALL SELECT min(doc_id) OVER (), doc_id FROM d WHERE len(w) = 0),
links AS (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other)
SELECT doc_id, min(other) AS class_id, doc_id = min(other) AS kept FROM reach GROUP BY doc_id
"""

OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1,
    CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3,
    CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT *, coalesce(array_to_string(l[1:a], ''), '') AS pre, coalesce(array_to_string(l[a + 1:b], ''), '') AS mid,
    coalesce(array_to_string(l[b + 1:], ''), '') AS suf
  FROM c)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

OP12 = r"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, CAST(i AS BIGINT) AS value, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN value % 2 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(value ORDER BY byte) AS tbl FROM steps WHERE k = 8),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
m AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f
  FROM benchmark),
own AS (SELECT rid, unnest(w) AS f FROM d),
names AS (
  SELECT f, hex(encode(f)) AS hx, octet_length(encode(f)) AS bytes
  FROM (SELECT f FROM own UNION SELECT f FROM m)),
bucket AS (
  SELECT f, xor(list_reduce(list_transform(range(0, bytes), lambda i: CAST('0x' || substr(hx, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
      lambda a, b: xor(a >> 8, tbl[CAST((xor(a, b) & 255) + 1 AS BIGINT)]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS b
  FROM names, crc),
s AS (SELECT b, count(*) AS s FROM own JOIN bucket USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM m JOIN bucket USING (f) GROUP BY b),
gain AS (
  SELECT i AS b, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000) AS DOUBLE)
    / CAST((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM range(10000) r(i) LEFT JOIN s ON s.b = i LEFT JOIN t ON t.b = i),
weights AS (
  SELECT rid, CAST(floor(sum(gain) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS weight
  FROM own JOIN bucket USING (f) JOIN gain USING (b) GROUP BY rid),
scores AS (
  SELECT d.rid, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
      AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (rid)),
ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n
  FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN CAST(rank AS BIGINT) END AS rank
FROM scores LEFT JOIN ranked USING (rid)
"""

SQL = {"op11_fim": OP11, "op12_importance": OP12, "op6_sharding": OP6, "op8_host_rules": OP8, "op9_embeddings": OP9, "op10_minhash": OP10}
