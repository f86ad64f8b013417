"""DuckDB text of the queries that SQL can express; the others are tested against brute-force versions."""

LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(strlen({0}::VARCHAR), ':', {0}::VARCHAR) END"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op3_line_dedup": """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, i, ls[i] AS a, ls[i + 1] AS b, ls[i + 2] AS c
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM d)),
later AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM later),
parts AS (SELECT doc_id, unnest(ls) AS x, generate_subscripts(ls, 1) AS i FROM d),
kept AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY i) AS t FROM parts ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT o.doc_id, coalesce(len(d.ls), 0)::BIGINT AS n_lines, coalesce(n.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM documents o LEFT JOIN d USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op6_decontamination": f"""
WITH i AS (SELECT item_id, regexp_extract_all({LOWERED.format('text')}, '{WORD}') AS ws FROM benchmark),
k AS (SELECT item_id, ws, least(len(ws), 5) AS k FROM i WHERE len(ws) > 0),
items AS (SELECT DISTINCT item_id, k, array_to_string(ws[p:p + k - 1], ' ') AS s
          FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM k)),
sized AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
d AS (SELECT doc_id, regexp_extract_all({LOWERED.format('text')}, '{WORD}') AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, k, array_to_string(ws[p:p + k - 1], ' ') AS s
             FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM k))),
hits AS (SELECT doc_id, item_id, count(*) AS n_found FROM shingles JOIN items USING (k, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_found, n AS n_shingles, round(n_found / n, 6) AS containment
FROM hits JOIN sized USING (item_id) WHERE n_found >= 0.8 * n - 1e-9
""",
    "op10_quality_rules": f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS ws,
             [x for x in string_split(text, chr(10)) if regexp_matches(x, '{WORD}')] AS ls FROM d),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 7], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS p FROM w)),
twice AS (SELECT doc_id, p FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(p, p + 8)) AS i FROM twice) GROUP BY doc_id),
m AS (SELECT w.doc_id, source, len(ws)::BIGINT AS n_words,
             length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
             coalesce(covered.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN covered USING (doc_id)),
r AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines) AS f
      FROM r GROUP BY source),
q AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM h),
s AS (SELECT m, CASE WHEN v > 0 THEN least(1e6, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1e6 END AS s FROM q),
verdict AS (SELECT source, (f + m * s) / (n + s) AS rate FROM h, s)
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= 0.5 AS kept, round(rate, 6) AS host_rate
FROM r JOIN verdict ON r.source IS NOT DISTINCT FROM verdict.source
""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, text,
         concat({FIELD.format('doc_id')}, {FIELD.format('source')}, {FIELD.format('lang')}, {FIELD.format('n_chars')}) AS head,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')]),
             lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS crc
  FROM documents),
l AS (SELECT r, doc_id, source, sha256(concat(head, {FIELD.format('text')})) AS leaf,
             CASE WHEN crc % 5 = 0 THEN sha256(concat(head, {FIELD.format(LOWERED.format('text'))}))
                  ELSE sha256(concat(head, {FIELD.format('text')})) END AS now FROM d),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM l),
nodes AS (
  SELECT source, 0 AS lvl, i, n, leaf AS h FROM ranked
  UNION ALL
  SELECT source, lvl + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY source, lvl, i // 16, n),
subs AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, i, n, h FROM subs
  UNION ALL
  SELECT lvl + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY lvl, i // 16, n),
kids AS (SELECT source, lvl, i // 16 AS up, list(h ORDER BY i) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
top_kids AS (SELECT lvl, i // 16 AS up, list(h ORDER BY i) AS hs FROM tops WHERE n > 1 GROUP BY ALL),
steps AS (
  SELECT r.r, k.lvl AS step, (r.i // (16 ** k.lvl)::BIGINT) % 16 AS place, k.hs FROM ranked r
  JOIN kids k ON k.source IS NOT DISTINCT FROM r.source AND k.up = r.i // (16 ** (k.lvl + 1))::BIGINT
  UNION ALL
  SELECT r.r, 100 + k.lvl, (s.i // (16 ** k.lvl)::BIGINT) % 16, k.hs FROM ranked r
  JOIN subs s ON s.source IS NOT DISTINCT FROM r.source JOIN top_kids k ON k.up = s.i // (16 ** (k.lvl + 1))::BIGINT),
paths AS (SELECT r, list({{'l': array_to_string(hs[1:place], ''), 'r': array_to_string(hs[place + 2:len(hs)], '')}} ORDER BY step) AS p FROM steps GROUP BY r),
fold AS (
  SELECT r, 1 AS j, now AS h FROM l
  UNION ALL
  SELECT r, j + 1, sha256(concat(p[j].l, h, p[j].r)) FROM fold JOIN paths USING (r) WHERE j <= len(p)),
folded AS (SELECT r, arg_max(h, j) AS folded_root FROM fold GROUP BY r)
SELECT l.doc_id, l.leaf, s.h AS subroot, t.h AS root,
       sha256(array_to_string([concat(x.l, x.r) for x in coalesce(p.p, [])], '')) AS proof_sha256, folded_root, folded_root = t.h AS verified
FROM l JOIN subs s ON s.source IS NOT DISTINCT FROM l.source JOIN tops t ON t.n = 1 LEFT JOIN paths p USING (r) JOIN folded USING (r)
""",
    "op13_ranked_search": f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED.format('text')}, '{TERM}') AS ws FROM documents),
d AS (SELECT r, doc_id, len(ws)::BIGINT AS n, ws FROM t WHERE len(ws) > 0),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
p AS (SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(ws) AS w FROM d) GROUP BY r, w),
f AS (SELECT w, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM p, s GROUP BY w, docs),
m AS (SELECT r, doc_id, 100 - 50 + (50 * n * docs) // terms AS m FROM d, s),
q AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all({LOWERED.format('text')}, '{TERM}')) AS w FROM benchmark),
x AS (SELECT item_id, text, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN f USING (w) JOIN p USING (w) JOIN m USING (r) GROUP BY item_id, text, r, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 50
""",
}
