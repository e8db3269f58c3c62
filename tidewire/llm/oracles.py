"""DuckDB SQL for the corpus queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op2_decontamination"] = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS MATERIALIZED (SELECT DISTINCT item_id, w[i:i + least(10, len(w)) - 1] AS win FROM b, unnest(generate_series(1, greatest(1, len(w) - 9))) AS g(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT len(win) AS n FROM win),
dw AS (SELECT rid, i, n, w[i:i + n - 1] AS win FROM d, lens, unnest(generate_series(1, len(w) - n + 1)) AS g(i) WHERE len(w) >= n),
hit AS MATERIALIZED (SELECT dw.rid, dw.i, dw.n, win.item_id FROM dw JOIN win USING (win)),
words AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM hit, unnest(generate_series(0, n - 1)) AS g(k) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

ORACLES["op1_embedding_dedup"] = r"""
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS MATERIALIZED (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS l FROM v),
p AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_inner_product(a.e, b.e) / (a.l * b.l) >= 0.95),
r(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN k ON k.a = vec_id LEFT JOIN c ON c.a = vec_id
"""

ORACLES["op10_substring_dedup"] = r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM d, unnest(generate_series(1, len(w) - 12)) AS g(i) WHERE len(w) >= 13),
least_doc AS (SELECT win, min(doc_id) AS m FROM win GROUP BY win HAVING min(doc_id) < max(doc_id)),
hit AS MATERIALIZED (SELECT DISTINCT doc_id, i + k AS i FROM win JOIN least_doc USING (win), unnest(generate_series(0, 12)) AS g(k) WHERE doc_id > m),
words AS (SELECT doc_id, i, w[i] AS word FROM d, unnest(generate_series(1, len(w))) AS g(i)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM words ANTI JOIN hit USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLES["op7_ngram_join"] = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(generate_series(1, greatest(1, len(w) - 4))) AS x(i) WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT o.a, o.b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL) o
  JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b WHERE 100 * o.o >= 75 * (x.n + y.n - o.o)),
r(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id
"""

# Every pair by exact similarity; MinHash finds those of the given tables.
ORACLES["op3_line_dedup"] = r"""
WITH RECURSIVE x AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS held FROM documents),
l AS MATERIALIZED (SELECT doc_id, k, trim(regexp_replace(lower(held[k]), '[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'), ' ') AS line FROM x, unnest(range(1, len(held) + 1)) AS g(k) WHERE doc_id IS NOT NULL),
d AS MATERIALIZED (SELECT row_number() OVER () AS id, line FROM (SELECT DISTINCT line FROM l WHERE line <> '')),
s AS MATERIALIZED (SELECT DISTINCT id, substr(line, i, 8) AS g FROM d, unnest(range(1, greatest(1, length(line) - 7) + 1)) AS r(i)),
o AS (SELECT g, count(*) AS often FROM s GROUP BY g),
n AS MATERIALIZED (SELECT id, g, count(*) OVER (PARTITION BY id) AS n, row_number() OVER (PARTITION BY id ORDER BY often, g) AS place FROM s JOIN o USING (g)),
head AS (SELECT id, g, n FROM n WHERE 5 * place <= n + 5),
c AS (SELECT DISTINCT a.id AS a, b.id AS b, a.n + b.n AS n FROM head a JOIN head b ON a.g = b.g AND a.id < b.id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
p AS MATERIALIZED (SELECT a, b FROM (SELECT a, b, c.n, count(*) AS shared FROM c JOIN s u ON u.id = a JOIN s v ON v.id = b AND v.g = u.g GROUP BY ALL) WHERE 9 * shared >= 4 * n),
e AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a),
q AS (SELECT l.doc_id, l.k, least(d.id, coalesce(m.b, d.id)) AS root FROM l JOIN d USING (line) LEFT JOIN m ON m.a = d.id),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, k, rank() OVER (PARTITION BY root ORDER BY doc_id, k) AS turn FROM q) WHERE turn > 1),
t AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id)
SELECT x.doc_id, CAST(coalesce(len(held), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(list_filter(ks, lambda k: k <= len(held))), 0) AS BIGINT) AS n_removed,
  CASE WHEN text IS NULL THEN NULL WHEN ks IS NULL THEN sha256(text) ELSE sha256(array_to_string(list_transform(list_filter(range(1, len(held) + 1), lambda k: NOT list_contains(ks, k)), lambda k: held[k]), chr(10))) END AS kept_sha256
FROM x LEFT JOIN t USING (doc_id)
"""

# 150 rounds, at which what is left of the first ranks is 0.85 ** 150.
ORACLES["op5_url_filter"] = r"""
WITH RECURSIVE p AS MATERIALIZED (SELECT page_id, html, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
f AS MATERIALIZED (SELECT page_id, html, host, path, CASE WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/en/7') THEN 'example.com/en/7'
  WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/de/8') THEN 'example.net/de/8'
  WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/en/') THEN 'com/en/' WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/de/') THEN 'net/de/'
  WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/es/') THEN 'org/es/' END AS rule FROM p),
v AS MATERIALIZED (SELECT page_id, html, host, path, rule, CASE WHEN rule IN ('example.com/en/7', 'net/de/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS verdict FROM f),
l AS (SELECT host AS src, regexp_replace(unnest(regexp_extract_all(html, '(?i)\bhref[ \t\n\x0B\f\r]*=[ \t\n\x0B\f\r]*(?:["''][^"'']*|[^ \t\n\x0B\f\r"''>]+)')), '(?i)^href[ \t\n\x0B\f\r]*=[ \t\n\x0B\f\r]*["'']?', '') AS href FROM v WHERE host <> '' AND html IS NOT NULL),
o AS (SELECT src, CASE WHEN prefix(href, '//') THEN 'http:' || href WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href END AS target FROM l),
j AS (SELECT src, CASE WHEN target IS NULL THEN src ELSE translate(regexp_extract(target, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS dst FROM o),
edges AS MATERIALIZED (SELECT src, dst, count(*) AS links FROM j WHERE dst <> '' GROUP BY src, dst),
ways AS (SELECT 'trust' AS kind, src, dst, links FROM edges UNION ALL SELECT 'distrust', dst, src, links FROM edges),
seeds AS (SELECT 'trust' AS kind, host, count(*) AS n FROM v WHERE host <> '' AND verdict = 'allow' GROUP BY host UNION ALL SELECT 'distrust', host, count(*) FROM v WHERE host <> '' AND verdict = 'block' GROUP BY host),
home AS MATERIALIZED (SELECT kind, host, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY kind) AS rank FROM seeds),
hosts AS (SELECT src AS host FROM edges UNION SELECT dst FROM edges UNION SELECT host FROM home),
moves AS MATERIALIZED (SELECT kind, src, dst, CAST(links AS DOUBLE) / sum(links) OVER (PARTITION BY kind, src) AS share FROM ways
  UNION ALL SELECT kind, host, host, 1.0 FROM hosts, (VALUES ('trust'), ('distrust')) AS x(kind) WHERE NOT EXISTS (SELECT 1 FROM ways WHERE ways.kind = x.kind AND ways.src = hosts.host)),
r(k, kind, host, rank) AS (SELECT 0, kind, host, rank FROM home UNION ALL
  SELECT k + 1, kind, host, sum(rank) FROM (
    SELECT r.k, r.kind, moves.dst AS host, 0.85 * r.rank * moves.share AS rank FROM r JOIN moves ON moves.kind = r.kind AND moves.src = r.host WHERE r.k < 150
    UNION ALL SELECT n.k, home.kind, home.host, 0.15 * home.rank FROM home, (SELECT max(k) AS k FROM r) AS n WHERE n.k < 150) GROUP BY k, kind, host),
scores AS (SELECT host, coalesce(sum(rank) FILTER (kind = 'trust'), 0) AS trust, coalesce(sum(rank) FILTER (kind = 'distrust'), 0) AS distrust FROM r WHERE k = 150 GROUP BY host)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN distrust > 0 AND distrust >= 0.5 * (trust + distrust) THEN 'block' ELSE 'allow' END) AS verdict, round(CASE WHEN trust + distrust > 0 THEN distrust / (trust + distrust) END, 3) AS distrust_share
FROM v LEFT JOIN scores USING (host)
"""

ORACLES["op8_mixing"] = r"""
WITH RECURSIVE c AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents),
s AS MATERIALIZED (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens, count(*) AS n_docs FROM c GROUP BY source HAVING sum(n_tokens) > 0),
t AS MATERIALIZED (SELECT CAST(sum(tokens) AS BIGINT) AS total, count(*) AS n, list(CAST(tokens AS DOUBLE)) AS held FROM s),
wide(step, low, high) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) UNION ALL
  SELECT step + 1, CASE WHEN fits THEN mid ELSE low END, CASE WHEN fits THEN high ELSE mid END FROM (
    SELECT step, low, high, mid, ln(list_sum(p)) - list_sum(list_transform(p, lambda x: x * ln(x))) / list_sum(p) >= 0.95 * ln(n) AS fits FROM (
      SELECT step, low, high, (low + high) / 2 AS mid, n, list_transform(held, lambda x: pow(x / total, (low + high) / 2)) AS p FROM wide, t WHERE step < 24))),
seldom(step, low, high) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) UNION ALL
  SELECT step + 1, CASE WHEN fits THEN low ELSE mid END, CASE WHEN fits THEN mid ELSE high END FROM (
    SELECT step, low, high, mid, total * list_max(list_transform(held, lambda x: pow(x / total, mid) / x)) / list_sum(list_transform(held, lambda x: pow(x / total, mid))) <= 4.0 AS fits FROM (
      SELECT step, low, high, (low + high) / 2 AS mid, total, held FROM seldom, t WHERE step < 24))),
e AS (SELECT CASE WHEN n < 2 THEN 1.0 ELSE greatest((SELECT low FROM wide WHERE step = 24), (SELECT high FROM seldom WHERE step = 24)) END AS exponent FROM t),
w AS (SELECT source, tokens, n_docs, total, pow(tokens / CAST(total AS DOUBLE), exponent) AS power FROM s, t, e),
x AS (SELECT source, tokens, n_docs, total, round(power / (SELECT sum(power) FROM w), 9) AS weight FROM w),
q AS MATERIALIZED (SELECT source, tokens, weight, CAST(floor(weight * CAST(total AS DOUBLE)) AS BIGINT) AS quota, CAST(ceil(n_docs / 4096.0) AS BIGINT) AS n_blocks FROM x),
d AS (SELECT doc_id, source, n_tokens, tokens, weight, quota, n_blocks, md5(concat_ws(':', 'mix', source, CAST(doc_id AS VARCHAR))) AS draw FROM c JOIN q USING (source)),
b AS MATERIALIZED (SELECT *, CAST('0x' || substr(draw, 1, 8) AS BIGINT) % n_blocks AS block FROM d),
g AS (SELECT source, block, sum(n_tokens) AS n FROM b GROUP BY source, block),
h AS (SELECT source, block, coalesce(sum(n) OVER (PARTITION BY source ORDER BY md5(concat_ws(':', 'mix', source, 'block', CAST(block AS VARCHAR))), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM g),
a AS (SELECT b.*, ahead + coalesce(sum(n_tokens) OVER (PARTITION BY b.source, b.block ORDER BY draw, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM b JOIN h ON h.source = b.source AND h.block = b.block),
k AS (SELECT doc_id, source, n_tokens, tokens, weight, quota, place, quota // tokens + CASE WHEN place < quota % tokens THEN 1 ELSE 0 END AS copies FROM a)
SELECT doc_id, source, CAST(n_tokens AS BIGINT) AS n_tokens, weight, CAST(copies AS BIGINT) AS copies,
  sha256(array_to_string(list_transform(range(CAST(copies AS BIGINT)), lambda i: CAST(round((i * tokens + place) / CAST(quota AS DOUBLE) * 1e9) AS BIGINT)), ',')) AS positions_sha256 FROM k WHERE copies > 0
"""

ORACLES["op12_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS MATERIALIZED (SELECT row_number() OVER () AS id, lang, piece FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
w AS (SELECT id, lang, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) AS word, generate_subscripts(regexp_extract_all(piece, '[^\x20\x09]+'), 1) AS i FROM p),
v AS MATERIALIZED (SELECT lang, word, lead(word, 1) OVER o AS next, lead(word, 2) OVER o AS last FROM w WINDOW o AS (PARTITION BY id ORDER BY i)),
g AS (SELECT lang, 1 AS k, word AS phrase FROM v UNION ALL SELECT lang, 2, word || ' ' || next FROM v WHERE next IS NOT NULL UNION ALL SELECT lang, 3, word || ' ' || next || ' ' || last FROM v WHERE last IS NOT NULL),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS x FROM f WHERE k > 1 AND a >= 10),
cut AS (SELECT c.*, j, h.a AS l, t.a AS r, CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(h.a AS HUGEINT) * t.a) AS BIGINT) AS score FROM c, unnest([1, 2]) AS s(j)
  JOIN f h ON h.lang = c.lang AND h.k = j AND h.phrase = array_to_string(x[1:j], ' ') JOIN f t ON t.lang = c.lang AND t.k = c.k - j AND t.phrase = array_to_string(x[j + 1:c.k], ' ') WHERE j < c.k),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
over_ AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, array_to_string(x[1:2], ' ') AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, array_to_string(x[2:3], ' '), a FROM c WHERE k = 3) GROUP BY lang, phrase),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
kept AS (SELECT low.* FROM low LEFT JOIN over_ o ON o.lang = low.lang AND o.phrase = low.phrase AND low.k = 2 WHERE o.longer IS NULL OR 100 * o.longer < 50 * low.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""

ORACLES["op11_conversation_repair"] = r"""
WITH RECURSIVE y AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS key FROM conversations),
-- CRC-32, bit by bit
z AS (SELECT *, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length(key) + 1), lambda k: CAST(unicode(substr(key, k, 1)) AS BIGINT))),
  lambda acc, b: list_reduce(list_concat([xor(acc, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda u, v: CASE WHEN u % 2 = 1 THEN xor(u >> 1, CAST(3988292384 AS BIGINT)) ELSE u >> 1 END)), CAST(4294967295 AS BIGINT)) % 20 AS h FROM y),
m AS MATERIALIZED (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM z, unnest(CASE WHEN h = 0 THEN [] WHEN h = 3 THEN [0, 1] ELSE [0] END) AS c(copy)),
o AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, role, text, left(role, 1) AS ini,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS tail FROM m),
f AS MATERIALIZED (SELECT *, CASE WHEN tail = '' THEN 'b' WHEN again THEN 'd' WHEN tail NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
  CASE WHEN i > 1 AND lag(ini) OVER (PARTITION BY c ORDER BY i) || ini NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS bad FROM o),
-- states: 0 nothing yet, 1 system, 2 user, 3 assistant; insertions (at most two in a row) lead from one to another
ins(q, p, cost, edits, lines) AS (SELECT q, q, 0, '', '' FROM unnest([0, 1, 2, 3]) AS s(q) UNION ALL
  SELECT q, CASE WHEN p = 2 THEN 3 ELSE 2 END, cost + 3, edits || 'I', lines || CASE WHEN p = 2 THEN chr(10) || 'assistant:' ELSE chr(10) || 'user:' END FROM ins WHERE cost < 6),
turn_(p, role, t) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
keep(p, ini, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3), (0, '', 0), (1, '', 1), (2, '', 2), (3, '', 3)),
arc AS MATERIALIZED (
  SELECT c, i, n, q, p AS t, ins.cost + 4 AS cost, edits || 'D' AS edits, lines FROM f, ins
  UNION ALL SELECT c, i, n, q, t, ins.cost + CASE WHEN fault = 't' THEN 3 ELSE 0 END, edits || 'K', lines || chr(10) || role || ':' || text FROM f JOIN keep USING (ini) JOIN ins USING (p) WHERE fault NOT IN ('b', 'd')
  UNION ALL SELECT c, i, n, q, t, ins.cost + 3 + CASE WHEN fault = 't' THEN 3 ELSE 0 END, edits || 'R', lines || chr(10) || turn_.role || ':' || text FROM f, turn_ JOIN ins USING (p) WHERE fault NOT IN ('b', 'd')),
best(c, i, q, cost, edits, lines) AS (SELECT DISTINCT c, CAST(0 AS BIGINT), 0, 0, '', '' FROM f UNION ALL
  SELECT c, i, t, cost, edits, lines FROM (SELECT b.c, a.i, a.t, b.cost + a.cost AS cost, b.edits || a.edits AS edits, b.lines || a.lines AS lines FROM best b JOIN arc a ON a.c = b.c AND a.i = b.i + 1 AND a.q = b.q)
  QUALIFY row_number() OVER (PARTITION BY c, t ORDER BY cost, edits) = 1),
done AS (SELECT b.c, b.cost + ins.cost AS cost, b.edits || ins.edits AS edits, b.lines || ins.lines AS lines FROM best b JOIN (SELECT DISTINCT c, n FROM f) x ON x.c = b.c AND x.n = b.i JOIN ins ON ins.q = b.q AND ins.p IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY b.c ORDER BY b.cost + ins.cost, b.edits || ins.edits) = 1),
s AS (SELECT c, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, sum(bad) AS illegal FROM f GROUP BY c)
SELECT k.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
  CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(edits, '') AS audit, sha256(coalesce(substr(lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN done ON done.c = s.c
"""
