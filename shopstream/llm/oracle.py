"""DuckDB twins of the queries that SQL can say."""

from __future__ import annotations

from .quality import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
win AS (
  SELECT rid, unnest(range(1, len(ws) - 1)) AS i,
         unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2])) AS k
  FROM w WHERE len(ws) >= 3),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
m AS (
  SELECT w.rid, doc_id, len(ws) AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(cov.n, 0) AS n_repeat_words, len(ls) AS n_lines,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims,
         len(list_filter(ws, lambda x: x IN ({_STOP}))) AS n_stop
  FROM w LEFT JOIN cov ON cov.rid = w.rid),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed
       AND word_chars / greatest(n_words, 1) BETWEEN 2.0 AND 15.0
       AND n_symbols / greatest(n_words, 1) <= 0.25
       AND n_stop / greatest(n_words, 1) BETWEEN 0.02 AND 0.9
       AND n_dup_lines / greatest(n_lines, 1) <= 0.5
       AND n_exclaims / greatest(n_words, 1) <= 0.25 AS kept
FROM b
"""

LINES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (
  SELECT rid, doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line FROM d),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last AS gone FROM k LEFT JOIN c ON c.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY rid, doc_id
"""

TOOL_CALLS = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, text, role, conv_id % 8 AS kind,
         CASE WHEN role = 'system' THEN 'configure' WHEN (conv_id + turn) % 3 = 0 THEN 'search'
              WHEN (conv_id + turn) % 3 = 1 THEN 'summarise' ELSE 'translate' END AS name,
         'call-' || conv_id || '-' AS id
  FROM conversations),
c0 AS (
  SELECT conv_id, turn, name, text, id || (CASE WHEN kind = 5 AND turn >= 4 THEN turn - 4 ELSE turn END) AS call_id,
         kind = 4 AND turn >= 2 AS broken,
         CASE kind WHEN 1 THEN [id || (turn + 2)]
                   WHEN 2 THEN CASE WHEN turn >= 2 THEN [id || (turn - 2), id || (turn + 2)] ELSE [id || (turn + 2)] END
                   WHEN 3 THEN [id || (turn + 2), id || (turn + 4)]
                   ELSE CASE WHEN turn >= 2 THEN [id || (turn - 2)] ELSE [] END END AS after
  FROM raw WHERE role IN ('user', 'system')),
c AS (SELECT * FROM c0 QUALIFY row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn) = 1),
r0 AS (
  SELECT conv_id, turn, text AS content, id || (CASE kind WHEN 6 THEN turn + 1 ELSE turn - 1 END) AS call_id
  FROM raw WHERE role = 'assistant'
  UNION ALL
  SELECT conv_id, turn + 1, text, id || (turn - 1) FROM raw WHERE role = 'assistant' AND kind = 7),
r AS (SELECT * FROM r0 QUALIFY row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn) = 1),
edge AS (
  SELECT e.conv_id, e.call_id, e.turn, e.dep, k.call_id IS NOT NULL AS known, k.turn AS dep_turn
  FROM (SELECT conv_id, call_id, turn, unnest(after) AS dep FROM c) e
  LEFT JOIN c k ON k.conv_id = e.conv_id AND k.call_id = e.dep),
missing AS (SELECT DISTINCT conv_id, call_id FROM edge WHERE NOT known),
wrong AS (SELECT DISTINCT conv_id FROM edge WHERE known AND dep_turn >= turn),
reach AS (
  SELECT conv_id, call_id, dep FROM edge WHERE known AND conv_id IN (SELECT conv_id FROM wrong)
  UNION
  SELECT e.conv_id, e.call_id, q.dep FROM edge e JOIN reach q ON q.conv_id = e.conv_id AND q.call_id = e.dep),
loops AS (SELECT conv_id, call_id FROM reach WHERE call_id = dep),
cyc AS (
  SELECT conv_id, call_id FROM loops UNION
  SELECT q.conv_id, q.call_id FROM reach q JOIN loops l ON l.conv_id = q.conv_id AND l.call_id = q.dep),
path AS (
  SELECT conv_id, call_id, 0 AS layer FROM c
  WHERE conv_id IN (SELECT conv_id FROM wrong) AND (conv_id, call_id) NOT IN (SELECT (conv_id, call_id) FROM cyc)
  UNION
  SELECT e.conv_id, e.call_id, p.layer + 1 FROM edge e JOIN path p ON p.conv_id = e.conv_id AND p.call_id = e.dep
  WHERE (e.conv_id, e.call_id) NOT IN (SELECT (conv_id, call_id) FROM cyc)),
deep AS (SELECT conv_id, call_id, max(layer) AS layer FROM path GROUP BY ALL),
j AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
         coalesce(c.turn, r.turn) AS seen, c.turn, c.text, c.name, c.broken, r.content,
         c.call_id IS NULL AS lone,
         CASE WHEN c.call_id IS NULL THEN 'orphan_result' WHEN r.call_id IS NULL THEN 'no_result'
              WHEN r.turn < c.turn THEN 'early_result' ELSE 'linked' END AS met,
         CASE WHEN c.call_id IS NULL THEN 'no call' ELSE
           concat_ws('; ', CASE WHEN broken THEN 'not JSON' END,
              CASE WHEN name = 'configure' THEN 'unknown tool'
                   WHEN broken THEN NULL
                   WHEN name = 'search' AND length(c.text) > 300 THEN '$.text: maxLength'
                   WHEN name = 'summarise' AND length(c.text) < 60 THEN '$.text: minLength'
                   WHEN name = 'translate' AND c.turn > 4 THEN '$.turn: maximum' END) END AS found
  FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.call_id = r.call_id),
k AS (
  SELECT j.*, cyc.call_id IS NOT NULL AND NOT lone AS looped, coalesce(deep.layer, 0) AS layer,
         concat_ws('; ', nullif(found, ''), CASE WHEN missing.call_id IS NOT NULL THEN 'unknown dependency' END) AS errors
  FROM j LEFT JOIN cyc ON cyc.conv_id = j.conv_id AND cyc.call_id = j.call_id
  LEFT JOIN deep ON deep.conv_id = j.conv_id AND deep.call_id = j.call_id
  LEFT JOIN missing ON missing.conv_id = j.conv_id AND missing.call_id = j.call_id)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY looped, layer, seen, call_id) AS position, call_id, name,
       CASE WHEN looped THEN 'cycle' ELSE met END AS status, errors = '' AS valid, errors,
       '{"arguments":' || CASE WHEN lone OR broken THEN 'null' ELSE
         '{"text":' || to_json(text)::VARCHAR || ',"turn":' || turn || '}' END
       || ',"call_id":' || to_json(call_id)::VARCHAR
       || ',"name":' || CASE WHEN name IS NULL THEN 'null' ELSE to_json(name)::VARCHAR END
       || ',"result":' || CASE WHEN content IS NULL THEN 'null' ELSE to_json(content)::VARCHAR END || '}' AS message
FROM k
"""

WINNOWING = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
dw AS (
  SELECT rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d),
iw AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, l, array_to_string(ws[i:i + l - 1], ' ') AS k FROM (
    SELECT item_id, ws, least(13, len(ws)) AS l, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i
    FROM iw WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT l FROM win),
pos AS (
  SELECT rid, l, i, array_to_string(ws[i:i + l - 1], ' ') AS k FROM (
    SELECT rid, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM dw, sizes WHERE len(ws) >= l)),
hit AS (SELECT rid, item_id, i, pos.l FROM pos JOIN win ON win.l = pos.l AND win.k = pos.k),
cov AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + l)) AS p FROM hit) GROUP BY rid),
its AS (
  SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS list
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS s FROM hit) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN cov ON cov.rid = dw.rid LEFT JOIN its ON its.rid = dw.rid
"""

SUFFIXES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(coalesce(text, '')) AS hx, strlen(coalesce(text, '')) AS n
  FROM documents),
win AS (
  SELECT rid, doc_id, i, substr(hx, 2 * i + 1, 100) AS k
  FROM (SELECT rid, doc_id, hx, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
gone AS (SELECT rid, i FROM (SELECT rid, i, doc_id, min(doc_id) OVER (PARTITION BY k) AS m FROM win) WHERE m < doc_id),
marked AS (
  SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM gone),
span AS (
  SELECT rid, s, min(i) AS a, max(i) + 50 AS z
  FROM (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS s FROM marked) GROUP BY rid, s),
gaps AS (
  SELECT rid, lag(z, 1, 0) OVER (PARTITION BY rid ORDER BY a) AS x, a AS y FROM span
  UNION ALL SELECT d.rid, coalesce(max(z), 0), max(n) FROM d LEFT JOIN span ON span.rid = d.rid GROUP BY d.rid),
kept AS (
  SELECT d.rid, string_agg(substr(hx, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS hx
  FROM gaps JOIN d ON d.rid = gaps.rid GROUP BY d.rid),
cut AS (SELECT rid, sum(z - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY rid)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(kept.hx)) AS kept_sha256
FROM d JOIN kept ON kept.rid = d.rid LEFT JOIN cut ON cut.rid = d.rid
"""

BLOCKS = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT rid, doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k
  FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)),
gone AS (
  SELECT rid, i FROM (
    SELECT rid, i, doc_id, min(doc_id) OVER (PARTITION BY k) AS m,
           row_number() OVER (PARTITION BY k, rid ORDER BY i) AS nth FROM win)
  WHERE m < doc_id OR nth > 1),
out AS (SELECT DISTINCT rid, unnest(range(i, i + 20)) AS p FROM gone),
w AS (SELECT rid, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM d),
k AS (
  SELECT w.rid, count(out.p) AS n_removed, string_agg(word, ' ' ORDER BY w.p) FILTER (out.p IS NULL) AS kept
  FROM w LEFT JOIN out ON out.rid = w.rid AND out.p = w.p GROUP BY w.rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.rid = d.rid
"""


def _centroids(k: int = 8, rounds: int = 10) -> str:
    """Lloyd's rounds unrolled, in 64-bit integers."""
    ctes = [f"""kept AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x))) = 64)""", """
v AS MATERIALIZED (
  SELECT rid, vec_id, embedding, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS c
  FROM kept)""", f"""
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, embedding) - 1 AS cluster, c FROM (
    SELECT *, sha256('3:' || vec_id) AS h FROM v) ORDER BY h, embedding LIMIT {k})"""]
    near = """
a{r} AS MATERIALIZED (
  SELECT rid, vec_id, c, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
    SELECT v.rid, v.vec_id, v.c, m.cluster, list_sum(list_transform(
      list_zip(v.c, m.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM v, c{r} AS m) GROUP BY rid, vec_id, c)"""
    for r in range(rounds):
        ctes.append(near.format(r=r))
        ctes.append(f"""
s{r} AS (
  SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (
    SELECT cluster, unnest(c) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY cluster, i),
c{r + 1} AS MATERIALIZED (
  SELECT c{r}.cluster, coalesce(n.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
    SELECT cluster, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{r} GROUP BY cluster) n
  ON n.cluster = c{r}.cluster)""")
    ctes.append(near.format(r=rounds))
    return "WITH " + ",".join(ctes) + f"""
SELECT a.vec_id, a.cluster::INTEGER AS cluster, a.d AS distance,
       (sum(a.d) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.c, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS m ON m.cluster = a.cluster
"""


DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT rid, lang, source, unnest(ws) AS term FROM d),
kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
cnt AS MATERIALIZED (
  SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN kept ON kept.lang = w.lang AND kept.term = w.term
  GROUP BY w.lang, source, w.term),
vs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(t.total, 0) AS total, coalesce(vs.v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM cnt GROUP BY lang, source) t
    ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN vs ON vs.lang = g.lang),
price AS MATERIALIZED (
  SELECT grp.lang, grp.source, kept.term, coalesce(cnt.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(cnt.n, 0) + 1)) // (grp.total + grp.v) AS p
  FROM grp JOIN kept ON kept.lang = grp.lang
  LEFT JOIN cnt ON cnt.lang = grp.lang AND cnt.source = grp.source AND cnt.term = kept.term),
both_ AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM price a JOIN price b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
  GROUP BY a.lang, a.source, b.source),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(both_.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN both_ ON both_.lang = a.lang AND both_.source = a.source AND both_.item = b.source),
over_ AS (
  SELECT p.lang, p.source, p.term, p.p, 1 + (1000000000::HUGEINT * (kept.n + 1)) // (vs.total + vs.v) AS q
  FROM price p JOIN kept ON kept.lang = p.lang AND kept.term = p.term JOIN vs ON vs.lang = p.lang WHERE p.n > 0),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
  FROM over_ WHERE p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 200
"""

ORACLE = {
    "op11_bitplane_centroids": _centroids(),
    "op12_level_products": DIVERGENCE,
    "op3_suffix_array_dedup": SUFFIXES,
    "op4_fixed_block_dedup": BLOCKS,
    "op1_tool_call_linking": TOOL_CALLS,
    "op2_winnowing_decontamination": WINNOWING,
    "op6_quality_rules": QUALITY,
    "op8_line_dedup": LINES,
}
