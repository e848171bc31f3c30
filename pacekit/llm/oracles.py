"""DuckDB SQL of the training-data queries that SQL can express, for the same tables."""

_WORD = r"[^\x20\x09-\x0D]+"
_WORDS = f"regexp_extract_all(coalesce(text, ''), '{_WORD}')"


def _draw(seed: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT"


ANN = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda a, b: a + b) AS score
  FROM (SELECT * FROM v WHERE vec_id % 20 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""

MIXING = f"""
WITH d AS (SELECT doc_id, source, len({_WORDS}) AS size, {_draw(6)} AS draw FROM documents),
w AS (SELECT source, sum(size)::BIGINT AS source_size, ([3.0, 1.0, 2.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
      FROM d GROUP BY source),
cap AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM w),
run AS (SELECT *, (1.5::DOUBLE * (SELECT sum(size) FROM d) - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM cap),
lev AS (SELECT arg_min(level, cap / weight) AS level FROM run WHERE weight * level <= cap),
p AS (SELECT cap.source, source_size, least(cap, weight * level) AS target FROM cap, lev),
q AS (SELECT *, floor(target)::BIGINT // nullif(source_size, 0) AS whole, floor(target)::BIGINT % nullif(source_size, 0) AS rest FROM p)
SELECT doc_id, size, source_size, target,
       (size * coalesce(whole, 0) + greatest(0, least(size, coalesce(rest, 0) - coalesce(sum(size) OVER (
          PARTITION BY d.source ORDER BY draw, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))))::BIGINT AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source"""

WARC = """
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> chief THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> chief THEN chief END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS chief FROM pages) p"""

WARC_SALVAGE = f"""
SELECT page_id, payload_bytes, payload_digest, record_type FROM ({WARC}) w WHERE page_id % 7 <> 3"""

QUALITY_RULES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
win AS (SELECT r, i, array_to_string(ws[i + 1:i + 8], ' ') AS w FROM (SELECT r, ws, unnest(range(0, len(ws) - 7)) AS i FROM d) x),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
cover AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(0, 8) u(k) GROUP BY r),
m AS (SELECT doc_id, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '{_WORD}')))
               - len(list_distinct(list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '{_WORD}')))) AS n_dup_lines,
             coalesce(cover.n, 0) AS n_repeat_words
      FROM d LEFT JOIN cover USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             CASE WHEN 10 * n_symbols > n_words THEN 10 * n_symbols / greatest(n_words, 1) ELSE 0 END
             + CASE WHEN word_chars < 2 * n_words THEN 2 * n_words / greatest(word_chars, 1) ELSE 0 END
             + CASE WHEN word_chars > 14 * n_words THEN word_chars / (14 * greatest(n_words, 1)) ELSE 0 END
             + CASE WHEN n_dup_lines > 3 THEN n_dup_lines / 3 ELSE 0 END
             + CASE WHEN 100 * n_repeat_words > 15 * n_words THEN 100 * n_repeat_words / (15 * greatest(n_words, 1)) ELSE 0 END AS severity FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed OR severity > 0) AS bad FROM f GROUP BY source),
g AS (SELECT sum(bad) / sum(n) AS mean, var_pop(bad / n) AS v FROM h),
z AS (SELECT mean, CASE WHEN v > 0 THEN least(greatest(mean * (1 - mean) / v - 1, 1), 10000) ELSE 10000 END AS strength FROM g)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR severity * rate > 0.5 * (1 - rate)) AS kept
FROM f JOIN (SELECT source, (bad + strength * mean) / (n + strength) AS rate FROM h, z) k ON f.source IS NOT DISTINCT FROM k.source"""

SHARDING = f"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT i, i, 0 FROM range(0, 256) r(i)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_draw(9)} AS draw,
             xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                 lambda x: ('0x' || x)::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
      FROM documents, tab),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY draw, doc_id NULLS FIRST, text_crc32, size) - 1 AS rk,
             count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY (2 * rk + 1) / (2 * n), source NULLS FIRST) - 1 AS pos FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(pos * 16 // total AS INTEGER) AS shard,
       pos - (pos * 16 // total * total + 15) // 16 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p"""

IMPORTANCE = r"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT i, i, 0 FROM range(0, 256) r(i)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
words AS (
  SELECT 0 AS side, r, w, count(*) AS n
  FROM (SELECT r, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
        FROM (SELECT row_number() OVER () AS r, coalesce(text, '') AS t FROM documents) d) x GROUP BY r, w
  UNION ALL
  SELECT 1, 0, w, count(*)
  FROM (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
        FROM benchmark) x GROUP BY w),
kinds AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda x: ('0x' || x)::BIGINT)),
                            lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM words) y, tab),
hist AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE side = 1), 0)::DOUBLE AS t
         FROM words JOIN kinds USING (w) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM hist) + 10000) / ((s + 1) * ((SELECT sum(t) FROM hist) + 10000))))::BIGINT AS g FROM hist),
mean AS (SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * g) / sum(n))::BIGINT AS weight
         FROM words JOIN kinds USING (w) JOIN gain USING (bucket) WHERE side = 0 GROUP BY r),
d AS (SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
      FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) a LEFT JOIN mean USING (r)),
e AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d),
f AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place FROM e)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * (SELECT count(*) FROM d WHERE n_features >= 20) // 100 THEN place END AS rank
FROM f"""

FILTER_AUDIT = f"""
WITH m AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS quality, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT part, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic,
             CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END
             + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN m.doc_id > min(m.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
      FROM m LEFT JOIN l ON m.doc_id = l.doc_id),
c AS (SELECT part, mask, quality, toxic, count(*) AS n FROM d GROUP BY ALL),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(x, b)),
steps AS (
  SELECT f1.x || f2.x || f3.x || f4.x || f5.x AS filter_order, s.step, [f1.b, f2.b, f3.b, f4.b, f5.b][s.step] AS f,
         CASE WHEN s.step > 1 THEN f1.b ELSE 0 END + CASE WHEN s.step > 2 THEN f2.b ELSE 0 END + CASE WHEN s.step > 3 THEN f3.b ELSE 0 END
           + CASE WHEN s.step > 4 THEN f4.b ELSE 0 END AS before
  FROM letters f1, letters f2, letters f3, letters f4, letters f5, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s
  WHERE f1.b + f2.b + f3.b + f4.b + f5.b = 31 AND len(list_distinct([f1.b, f2.b, f3.b, f4.b, f5.b])) = 5),
r AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN mask & (f | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & f <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & f <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & f <> 0 AND mask & before = 0 AND quality = 1 THEN n ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & f <> 0 AND mask & before = 0 AND toxic = 1 THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, steps GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM r"""
