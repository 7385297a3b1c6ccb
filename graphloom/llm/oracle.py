"""DuckDB SQL of the operators that SQL can express."""

#: Positions from the lengths of the parts between matches and of the matches.
_SECRETS = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
rules(k, kind, p, g, least) AS (VALUES
  (0, 'assign', '((?i)password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 18),
  (2, 'hex', '[0-9a-f]+', 0, 16)),
cuts AS (
  SELECT r, 0 AS k, 'assign' AS kind, 12 AS least, regexp_split_to_array(t, '((?i)password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS parts,
    regexp_extract_all(t, '((?i)password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS whole,
    regexp_extract_all(t, '((?i)password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS val FROM docs
  UNION ALL SELECT r, 1, 'access', 18, regexp_split_to_array(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+') FROM docs
  UNION ALL SELECT r, 2, 'hex', 16, regexp_split_to_array(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+') FROM docs),
each AS (SELECT r, k, kind, least, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS p, unnest(whole) AS w, unnest(val) AS v FROM cuts),
placed AS (SELECT r, k, kind, least, length(v) AS n, length(w) AS own, sum(length(p) + length(w)) OVER (PARTITION BY r, k ORDER BY i) AS e FROM each WHERE w IS NOT NULL),
good AS (SELECT r, k, kind, (e - own)::BIGINT AS s, e::BIGINT AS e FROM placed WHERE n >= least),
found AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM good GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (r)
"""
_SECRETS = _SECRETS.replace(_SECRETS[_SECRETS.index("rules(k") : _SECRETS.index("cuts AS")], "")

_WORDS = r"regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DECONTAMINATION = f"""
WITH d AS (SELECT r, doc_id, {_WORDS} AS w FROM (SELECT row_number() OVER () AS r, doc_id, {_LOWER} AS lower_ascii FROM documents)),
b AS (SELECT item_id, {_WORDS} AS w FROM (SELECT item_id, {_LOWER} AS lower_ascii FROM benchmark)),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS key FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT DISTINCT r, n, i, item_id FROM dw JOIN bw USING (n, key)),
words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS listed FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

#: CRC-32 byte by byte over the distinct words, by a table made from the polynomial.
_IMPORTANCE = f"""
WITH tab AS MATERIALIZED (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS tab),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM (SELECT doc_id, {_LOWER} AS lower_ascii FROM documents)),
b AS MATERIALIZED (SELECT unnest({_WORDS}) AS w FROM (SELECT {_LOWER} AS lower_ascii FROM benchmark)),
dw AS MATERIALIZED (SELECT r, unnest(w) AS w FROM d),
known AS MATERIALIZED (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM b)),
spelt AS (SELECT w, hex(w) AS h FROM known),
crc AS MATERIALIZED (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || h[2 * i - 1:2 * i])::BIGINT)), lambda c, x: xor(tab[(xor(c, x) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 10000 AS k FROM spelt, tab),
s AS (SELECT k, count(*) AS s FROM dw JOIN crc USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN crc USING (w) GROUP BY k),
g AS (SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (k)),
m AS (SELECT r, floor(sum(gain) / count(*))::BIGINT AS weight FROM dw JOIN crc USING (w) JOIN g USING (k) GROUP BY r),
scored AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN m USING (r)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n * 10 // 100 THEN place END AS rank FROM placed
"""

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LINES = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS MATERIALIZED (SELECT r, doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM d),
k AS MATERIALIZED (SELECT *, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT r) >= 5),
marked AS (SELECT r, i, line, keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone FROM k LEFT JOIN common USING (key)),
kept AS (SELECT r, count(*) FILTER (gone) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS text FROM marked GROUP BY r)
SELECT doc_id, len(lines)::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(coalesce(text, '')) AS kept_sha256 FROM d JOIN kept USING (r)
"""

#: A plain walk over the rows of whole conversations, texts carried along.
_CONVERSATIONS = r"""
WITH RECURSIVE tab AS MATERIALIZED (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS tab),
numbered AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS h FROM conversations),
hashed AS (SELECT c, conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || h[2 * i - 1:2 * i])::BIGINT)), lambda a, x: xor(tab[(xor(a, x) & 255) + 1], a >> 8)), 4294967295::BIGINT) % 20 AS kind FROM numbered, tab),
hurt AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM hurt),
seen AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open, lag(role[1:1]) OVER (PARTITION BY c ORDER BY i) || role[1:1] AS pair FROM placed),
judged AS MATERIALIZED (SELECT *, blank OR again AS must, (NOT blank AND NOT again AND open)::INT AS cut_off, role[1:1] AS x FROM seen),
counts AS (SELECT c, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate, sum(cut_off) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY c),
put(p, m, cost, audit, lines) AS (VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (3, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']), (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])),
edit(m, x, q, cost, audit) AS (VALUES (0, NULL, 0, 3, 'D'), (1, NULL, 1, 3, 'D'), (2, NULL, 2, 3, 'D'), (3, NULL, 3, 3, 'D'), (0, 's', 1, 0, 'K'), (0, 'u', 2, 0, 'K'), (1, 'u', 2, 0, 'K'), (2, 'a', 3, 0, 'K'), (3, 'u', 2, 0, 'K'), (0, NULL, 2, 2, 'R'), (1, NULL, 2, 2, 'R'), (3, NULL, 2, 2, 'R'), (2, NULL, 3, 2, 'R')),
walk(c, i, q, cost, audit, lines) AS (
  SELECT c, 0::BIGINT, 0, 0::BIGINT, '', []::VARCHAR[] FROM counts
  UNION ALL
  SELECT c, i, q, best.cost, best.audit, best.lines FROM (
    SELECT w.c, r.i, e.q, min({'cost': w.cost + put.cost + e.cost + CASE WHEN e.audit = 'D' THEN 0 ELSE r.cut_off END, 'audit': w.audit || put.audit || e.audit,
      'lines': w.lines || put.lines || CASE e.audit WHEN 'K' THEN [r.role || ':' || r.text] WHEN 'R' THEN [CASE e.q WHEN 2 THEN 'user:' ELSE 'assistant:' END || r.text] ELSE [] END}) AS best
    FROM walk w JOIN judged r ON r.c = w.c AND r.i = w.i + 1 JOIN put ON put.p = w.q JOIN edit e ON e.m = put.m AND (e.audit = 'D' OR NOT r.must) AND (e.x IS NULL OR e.x = r.x) GROUP BY ALL)),
done AS (SELECT c, min({'cost': cost + CASE q WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END, 'audit': audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END, 'lines': lines || CASE q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END}) AS best FROM walk JOIN counts USING (c) WHERE i = n GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM numbered) LEFT JOIN counts USING (c) LEFT JOIN done USING (c)
"""

SQL = {"op2_secret_ledger": _SECRETS, "op6_decontamination": _DECONTAMINATION, "op11_importance_resampling": _IMPORTANCE, "op12_line_dedup": _LINES, "op13_conversation_repair": _CONVERSATIONS}
