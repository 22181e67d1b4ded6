"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

#: Exact near duplicates: all pairs that share a shingle, then the least reachable id.
OP4 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), listed AS (
  SELECT doc_id, CASE WHEN len(w) >= 2
    THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
    ELSE w END AS s
  FROM words
), sets AS (
  SELECT doc_id, unnest(s) AS g FROM listed
), sizes AS (
  SELECT doc_id, len(s) AS n FROM listed
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes
  UNION
  SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
)
SELECT doc_id, n::BIGINT AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM sizes JOIN reach ON a = doc_id GROUP BY doc_id, n
"""

#: Counts per document, rule failures per host, rates shrunk by a beta prior.
OP1 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)
), twice AS (
  SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest(range(i, i + 5)) AS p FROM windows JOIN twice USING (r, g)) GROUP BY r
), lines AS (
  SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line
), line_counts AS (
  SELECT r, sum(n) AS n_lines, sum(n - 1) AS n_dup FROM lines GROUP BY r
), m AS (
  SELECT d.r, doc_id, host, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines
  FROM d LEFT JOIN covered USING (r) LEFT JOIN line_counts USING (r)
), j AS (
  SELECT *, n_words < 10 AS f1, 100 * n_repeat_words > 20 * n_words AS f2,
    10 * n_symbols > n_words AS f3, 100 * n_dup_lines > 30 * n_lines AS f4 FROM m
), failed AS (
  SELECT host, rule, count(*) AS n, sum(f::INT) AS f
  FROM (SELECT host, unnest([1, 2, 3, 4]) AS rule, unnest([f1, f2, f3, f4]) AS f FROM j) GROUP BY host, rule
), prior AS (
  SELECT rule, sum(f) / sum(n) AS p, sum(n * pow(f / n - q, 2)) / sum(n) - any_value(q) * (1 - any_value(q)) * count(*) / sum(n) AS v,
    count(*) / sum(n) AS c
  FROM failed JOIN (SELECT rule, sum(f) / sum(n) AS q FROM failed GROUP BY rule) USING (rule) GROUP BY rule
), strength AS (
  SELECT rule, p, CASE WHEN v > 0 AND c < 1 THEN least(1000, greatest(5, p * (1 - p) * (1 - c) / v - 1)) ELSE 1000 END AS s FROM prior
), verdict AS (
  SELECT host, max((f + p * s) / (n + s)) > 0.5 AS rejected FROM failed JOIN strength USING (rule) GROUP BY host
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
  NOT (f1 OR f2 OR rejected) AS kept
FROM j JOIN verdict USING (host)
"""

#: Signs of the vectors, all rows against every query.
OP5 = r"""
WITH c AS (
  SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS b FROM embeddings
), d AS (
  SELECT q.vec_id AS query_id, o.vec_id,
    list_sum(list_transform(range(1, len(q.b) + 1), lambda i: (q.b[i] != o.b[i])::INT))::INT AS distance
  FROM c q JOIN c o ON q.vec_id != o.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank, vec_id, distance
FROM d QUALIFY rank <= 10
"""

#: Pairs of equal words of one text; neighbouring pairs with the same distance make a run.
OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), c AS (
  -- The checksum of the id, bit by bit.
  SELECT r, list_reduce(list_prepend((4294967295)::UBIGINT, list_transform(
      string_split(CASE WHEN doc_id IS NULL THEN '' ELSE doc_id::VARCHAR END, ''), lambda x: ord(x)::UBIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: i::UBIGINT)),
      lambda s, i: CASE WHEN s % 2 = 1 THEN xor(s // 2, (3988292384)::UBIGINT) ELSE s // 2 END)) AS x FROM d
), g AS (
  SELECT r, doc_id, w, len(w) AS n, xor(x, (4294967295)::UBIGINT)::BIGINT AS h FROM d JOIN c USING (r)
), cut AS (
  SELECT r, doc_id, w, n, h % 10 = 0 AND n > 0 AS planted, CASE WHEN n > 0 THEN (h // 10) % n END AS a,
    3 + (h // 10) % 8 AS k FROM g
), t AS (
  SELECT r, doc_id, n, i, CASE WHEN planted AND i >= a THEN w[a + (i - a) % (1 + (n - a) // k) + 1] ELSE w[i + 1] END AS v
  FROM (SELECT *, unnest(range(n)) AS i FROM cut)
), pairs AS (
  SELECT x.r, y.i - x.i AS q, x.i FROM t x JOIN t y ON x.r = y.r AND x.v = y.v AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pairs) GROUP BY r, q, k
), runs AS (
  SELECT r, start, length, min(q) AS period FROM islands
  WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length
), listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s,
    first({'start': start, 'length': length, 'period': period} ORDER BY length DESC, start, period) AS best
  FROM runs GROUP BY r
), dropped AS (
  SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT t.r, string_agg(v, ' ' ORDER BY t.i) AS s FROM t ANTI JOIN dropped ON t.r = dropped.r AND t.i = dropped.i GROUP BY t.r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  (1000 * best.length // best.period)::BIGINT AS exponent_milli,
  sha256(coalesce(listed.s, '')) AS runs_sha256, sha256(coalesce(kept.s, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""

#: Candidates of every kind, with their places; owners and repositories of each value.
OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), kinds(kind, rank, before, pattern, part, least, base) AS (VALUES
  ('assign', 0, '', '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1, 8, true),
  ('access', 1, '', 'AKIA[A-Z0-9]+', 0, 16, true),
  ('hex', 2, '', '[0-9a-f]+', 0, 32, true),
  ('provider', 3, '[^A-Za-z0-9]', '(gh[pousr]_|glpat-|xox[abprs]-|sk_live_|AIza)[A-Za-z0-9_-]{16,}', 0, 1, false),
  ('jwt', 4, '[^A-Za-z0-9_-]', 'eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}', 0, 1, false),
  ('bearer', 5, '', 'Bearer\x20([A-Za-z0-9+/_.=-]{16,})', 1, 1, false),
  ('url', 6, '', '://[^\s/:@]{1,64}:([^\s/:@]{8,64})@', 1, 1, false)
), full_kinds AS (
  SELECT *, CASE WHEN before = '' THEN '()' ELSE '(^|' || before || ')' END AS lead FROM kinds
), pieces AS (
  SELECT r, k.kind, rank, least, base, part, lead, pattern,
    unnest(regexp_extract_all(t, lead || pattern)) AS f,
    unnest(string_split_regex(t, lead || pattern)[:len(regexp_extract_all(t, lead || pattern))]) AS g,
    unnest(range(len(regexp_extract_all(t, lead || pattern)))) AS i
  FROM d, full_kinds k
), placed AS (
  SELECT *, sum(length(f) + length(g)) OVER (PARTITION BY r, kind ORDER BY i) AS stop FROM pieces
), valued AS (
  SELECT r, kind, rank, base, least,
    stop - length(f) + length(regexp_extract(f, lead || pattern, 1)) AS start, stop,
    CASE WHEN part = 0 THEN substr(f, length(regexp_extract(f, lead || pattern, 1)) + 1)
      ELSE regexp_extract(f, lead || pattern, 2) END AS v
  FROM placed
), held AS (
  SELECT valued.*, doc_id, source FROM valued JOIN d USING (r) WHERE length(v) >= least
), owned AS (
  SELECT v, count(*) AS owners FROM (SELECT DISTINCT v, coalesce(source, chr(0)) AS source FROM held) GROUP BY v
), judged AS (
  SELECT *, CASE WHEN owners >= 3 THEN 'copied'
    WHEN regexp_matches(v, '[0-9]') AND len(list_distinct(string_split(v, ''))) >= 8 AND NOT regexp_matches(v,
      '(?i)example|sample|dummy|changeme|placeholder|your[_-]?|xxxx|test|12345678|abcdefgh')
    THEN 'live' ELSE 'weak' END AS verdict,
    kind || ':' || start::BIGINT || ':' || stop::BIGINT AS s
  FROM held JOIN owned USING (v)
)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(s, ',' ORDER BY start, rank) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg(s, ',' ORDER BY start, rank) FILTER (base OR verdict = 'live'), '') AS spans,
  coalesce(string_agg(s, ',' ORDER BY start, rank) FILTER (verdict = 'live'), '') AS live,
  coalesce(string_agg(s, ',' ORDER BY start, rank) FILTER (verdict = 'copied'), '') AS copied
FROM d LEFT JOIN judged USING (r) GROUP BY r, d.doc_id
"""

#: Units of every text, cut where the digest of the id says.
OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS x
  FROM documents
), h AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
    ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, u,
    CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), s AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
    array_to_string(u[b + 1:], '') AS z
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form != 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form != 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || z || '<P>' || p || '<M>' || m
    ELSE '<P>' || p || '<S>' || z || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM s
"""

SQL = {
    "op1_host_quality_rules": OP1,
    "op4_minhash_near_dedup": OP4,
    "op5_hamming_top_k": OP5,
    "op11_periodic_runs": OP11,
    "op12_secret_ownership": OP12,
    "op13_fill_in_middle": OP13,
}
