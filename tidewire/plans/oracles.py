"""DuckDB SQL for the registered queries."""

from tidewire.plans.adapters import RECORDS

_R = RECORDS.replace("{S}", "VARCHAR").replace("{MS}", "(epoch_us(ts) // 1000)").replace("{events}", "events")
_L = """
WITH base AS (SELECT event_id AS seq, concat('txn-', CAST(user_id AS VARCHAR)) AS tid,
  CASE event_type WHEN 'signup' THEN 'INIT' WHEN 'view' THEN 'ADD' WHEN 'error' THEN 'END' ELSE 'MSG' END AS kind,
  event_type, props, event_id % 5 AS r5, event_id % 3 AS r3 FROM events),
cnt AS (SELECT *, sum(CASE WHEN kind = 'INIT' THEN 1 ELSE 0 END) OVER (PARTITION BY tid ORDER BY seq ROWS UNBOUNDED PRECEDING) AS inits,
  min(CASE WHEN kind = 'INIT' THEN seq END) OVER (PARTITION BY tid) AS first_init FROM base),
pid AS (SELECT tid, row_number() OVER (ORDER BY first_init) AS pid FROM (SELECT DISTINCT tid, first_init FROM cnt WHERE first_init IS NOT NULL) z)
SELECT c.seq, c.tid, c.kind, c.event_type AS topic, c.props AS value,
 CASE WHEN c.kind IN ('ADD', 'END') THEN CASE WHEN c.inits > 0 THEN p.pid ELSE -1 END END AS claimed_pid,
 CASE WHEN c.kind IN ('ADD', 'END') THEN CAST(greatest(c.inits, 1) - 1 - CASE WHEN c.r5 = 0 THEN 1 ELSE 0 END AS INT) END AS claimed_epoch,
 CASE WHEN c.kind = 'END' THEN c.r3 <> 0 END AS is_commit, p.pid AS pid
FROM cnt c LEFT JOIN pid p ON c.tid = p.tid
"""
_M = f"WITH m AS MATERIALIZED ({_R}), "
_SAFE = "regexp_replace(topic, '^\\.\\./', '')"

_J = r"""
h AS (SELECT *, CASE WHEN seq % 5 = 0 THEN NULL ELSE CASE WHEN seq % 4 = 0 THEN 'dup' ELSE topic END END AS hv,
  strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S') || CASE WHEN ts_ms % 1000 = 0 THEN '' ELSE '.' || rtrim(lpad(CAST(ts_ms % 1000 AS VARCHAR), 3, '0'), '0') END || ' +0000 UTC' AS ts_text FROM m),
j AS (SELECT *, '{"topic":' || to_json(topic) || ',"partition":' || part || ',"offset":' || off
  || CASE WHEN k IS NULL THEN '' ELSE ',"key":' || KEY || ',"key_encoding":"KENC"' END
  || ',"value":' || VALUE || ',"value_encoding":"VENC"'
  || CASE WHEN hv IS NULL THEN '' ELSE ',"headers":{"h":' || to_json(hv) || ',"src":"<a>&b"}' END
  || CASE WHEN ts_ms IS NULL THEN '' ELSE ',"timestamp":"' || ts_text || '"' END
  || ',"client_addr":' || to_json(client_addr) || '}' AS raw FROM h),
line AS (SELECT *, replace(replace(replace(raw, '&', chr(92) || 'u0026'), '<', chr(92) || 'u003c'), '>', chr(92) || 'u003e') AS line FROM j)
"""


def _jsonl(key: bool = False, value: bool = False) -> str:
    pack = {True: "to_json(base64(encode({})))", False: "to_json({})"}
    name = {True: "base64", False: "utf-8"}
    return _M + _J.replace("KEY", pack[key].format("k")).replace("KENC", name[key]).replace("VALUE", pack[value].format("coalesce(v, '')")).replace("VENC", name[value])


_T = f"""WITH log AS MATERIALIZED ({_L}),
ini AS (SELECT seq, tid, row_number() OVER (PARTITION BY tid ORDER BY seq) - 1 AS n FROM log WHERE kind = 'INIT'),
tak AS (SELECT tid, n // 32768 AS turn, row_number() OVER (ORDER BY seq) AS pid FROM ini WHERE n % 32768 = 0),
ses AS (SELECT ini.seq, ini.tid, tak.pid, CAST(ini.n % 32768 AS INT) AS epoch FROM ini JOIN tak ON tak.tid = ini.tid AND tak.turn = ini.n // 32768),
cur AS (SELECT log.*, last_value(ses.pid IGNORE NULLS) OVER w AS cp, last_value(ses.epoch IGNORE NULLS) OVER w AS ce FROM log LEFT JOIN ses ON log.seq = ses.seq
  WINDOW w AS (PARTITION BY log.tid ORDER BY log.seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
val AS (SELECT *, CASE WHEN kind IN ('ADD', 'END') THEN coalesce(claimed_pid = cp AND claimed_epoch = ce, false) END AS valid FROM cur),
op AS (SELECT *, CASE WHEN kind = 'ADD' AND valid THEN true WHEN kind = 'INIT' OR (kind = 'END' AND valid) THEN false END AS opens FROM val),
res AS (SELECT *, kind = 'INIT' AND coalesce(last_value(opens IGNORE NULLS) OVER (PARTITION BY tid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS zombie FROM op),
ter AS (SELECT *, CASE WHEN zombie THEN 'ABORT' WHEN kind = 'END' AND valid THEN CASE WHEN is_commit THEN 'COMMIT' ELSE 'ABORT' END END AS terminal FROM res),
nxt AS (SELECT *, last_value(terminal IGNORE NULLS) OVER w AS nt, last_value(CASE WHEN terminal IS NOT NULL THEN seq END IGNORE NULLS) OVER w AS end_seq FROM ter
  WINDOW w AS (PARTITION BY tid ORDER BY seq DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
msg AS (SELECT seq, tid AS transactional_id, topic, value, coalesce(nt, 'OPEN') AS outcome, end_seq FROM nxt WHERE kind = 'MSG'),
com AS (SELECT *, 'out/' || topic || '/' || transactional_id || '.log' AS path FROM msg WHERE outcome = 'COMMIT'),
new AS (SELECT com.* FROM com JOIN (SELECT path, max(end_seq) AS end_seq FROM com GROUP BY path) z USING (path, end_seq)) """

_CHUNKS = """b AS (SELECT *, sum(strlen(line)) OVER (PARTITION BY path ORDER BY seq) - strlen(line) AS start FROM l),
files AS (SELECT path, CAST(start // 256 AS BIGINT) AS chunk, CAST(min(start) AS BIGINT) AS start, string_agg(line, '' ORDER BY seq) AS content FROM b GROUP BY path, start // 256)"""
_ALLOWED = "topic IN ('click', 'purchase', 'view')"
_BAD = "e AS (SELECT m.*, b.request_id IS NOT NULL AS parse_error, m.request_id % 23 = 0 AS failed FROM m LEFT JOIN (SELECT DISTINCT request_id, topic, part FROM m WHERE seq % 97 = 0) b ON m.request_id = b.request_id AND m.topic = b.topic AND m.part = b.part) "

ORACLES = {
    "messages": _M[:-2] + " SELECT seq, request_id, topic, part, off, hex(encode(k)) AS key_hex, hex(encode(v)) AS value_hex, CAST(CASE WHEN seq % 5 = 0 THEN 0 ELSE 2 END AS INT) AS n_headers, ts_ms, v IS NULL AS tombstone, client_addr, transactional_id FROM m",
    "headers_last_wins": _M[:-2] + " SELECT seq, CASE WHEN seq % 5 = 0 THEN '' ELSE 'h=' || CASE WHEN seq % 4 = 0 THEN 'dup' ELSE topic END || ',src=<a>&b' END AS headers FROM m",
    "event_log": f"SELECT seq, tid AS transactional_id, kind, claimed_pid, claimed_epoch, is_commit FROM ({_L})",
    "jsonl_roundtrip": _M[:-2] + " SELECT topic, part, off, hex(encode(k)) AS key_hex, hex(encode(coalesce(v, ''))) AS value_hex, ts_ms, client_addr FROM m",
    "filter_topics": _M[:-2] + f" SELECT seq, topic FROM m WHERE {_ALLOWED}",
    "rejected_topics": _M[:-2] + f" SELECT seq, topic, CAST(3 AS INT) AS error_code FROM m WHERE NOT {_ALLOWED}",
    "tombstones": _M[:-2] + " SELECT seq, topic, true AS tombstone FROM m WHERE v IS NULL",
    "non_transactional": _M[:-2] + " SELECT seq, topic FROM m WHERE transactional_id IS NULL",
    "render_binary": _M[:-2] + " SELECT seq, hex(encode(coalesce(v, ''))) || '0D0A' AS payload_hex FROM m",
    "render_jsonl": _jsonl() + "SELECT seq, line || chr(10) AS payload FROM line",
    "render_jsonl_b64key": _jsonl(key=True) + "SELECT seq, line || chr(10) AS payload FROM line",
    "render_jsonl_b64value": _jsonl(value=True) + "SELECT seq, line || chr(10) AS payload FROM line",
    "render_template": _M[:-2] + " SELECT seq, concat('at ', coalesce(ts_ms, -1), ': ', topic, '/', part, '@', off, chr(9), '<', coalesce(strlen(k), -1), '>', coalesce(k, ''), '=<', coalesce(strlen(v), 0), '>', coalesce(v, ''), '%', chr(10)) AS payload FROM m",
    "topic_id": _M[:-2] + " SELECT seq, substr(sha256(topic), 1, 32) AS topic_id FROM m",
    "safe_segment": _M[:-2] + f" SELECT seq, {_SAFE} AS segment FROM m",
    "resolve_path": _M[:-2] + f" SELECT seq, 'out/' || {_SAFE} || '/' || transactional_id || '.log' AS path FROM m WHERE transactional_id IS NOT NULL",
    "http_request": _M[:-2] + """ SELECT seq, 'http://collector.example/in' AS url, hex(encode(coalesce(v, ''))) || '0A' AS body_hex,
 concat('content-type=application/octet-stream', chr(10), 'x-kafka-client-addr=', client_addr, CASE WHEN seq % 5 = 0 THEN '' ELSE concat(chr(10), 'x-kafka-header-h=', CASE WHEN seq % 4 = 0 THEN 'dup' ELSE topic END, chr(10), 'x-kafka-header-src=<a>&b') END,
 CASE WHEN k IS NULL THEN '' ELSE concat(chr(10), 'x-kafka-key=', base64(encode(k))) END, chr(10), 'x-kafka-offset=', off, chr(10), 'x-kafka-partition=', part, CASE WHEN ts_ms IS NULL THEN '' ELSE concat(chr(10), 'x-kafka-timestamp=', ts_ms) END, chr(10), 'x-kafka-topic=', topic) AS headers FROM m""",
    "produce_outcomes": _M + _BAD + f"SELECT request_id, topic, part, CAST(CASE WHEN NOT {_ALLOWED} THEN 3 WHEN bool_or(parse_error) THEN 2 WHEN bool_or(failed) THEN -1 ELSE 0 END AS INT) AS code, count(*) AS n FROM e GROUP BY request_id, topic, part",
    "request_batches": _M + _BAD + f"SELECT request_id, count(*) AS n, CAST(coalesce(sum(strlen(v)), 0) AS BIGINT) AS bytes, count(DISTINCT topic) AS n_topics FROM e WHERE {_ALLOWED} AND NOT parse_error GROUP BY request_id",
    "assemble_files": _M + f"l AS (SELECT 'out/' || {_SAFE} || '.log' AS path, seq, concat(off, ':', coalesce(v, ''), chr(10)) AS line FROM m), {_CHUNKS} SELECT path, chunk, start, sha256(content) AS content_sha256, CAST(strlen(content) AS BIGINT) AS n_bytes FROM files",
    "path_collisions": _M[:-2] + f" SELECT {_SAFE} AS path, string_agg(DISTINCT topic, ',' ORDER BY topic) AS names FROM m GROUP BY 1 HAVING count(DISTINCT topic) > 1",
    "producer_sessions": _T + "SELECT seq, tid AS transactional_id, pid, epoch FROM ses",
    "fence_checks": _T + "SELECT seq, tid AS transactional_id, kind, NOT valid AS fenced FROM val WHERE kind IN ('ADD', 'END')",
    "zombie_aborts": _T + "SELECT seq, tid AS transactional_id FROM res WHERE zombie",
    "txn_terminals": _T + "SELECT seq, tid AS transactional_id, terminal, zombie FROM ter WHERE terminal IS NOT NULL",
    "txn_outcomes": _T + "SELECT seq, transactional_id, topic, outcome, end_seq FROM msg",
    "committed_messages": _T + "SELECT seq, transactional_id, topic, value FROM com",
    "aborted_messages": _T + "SELECT seq, transactional_id, outcome FROM msg WHERE outcome <> 'COMMIT'",
    "latest_commit": _T + "SELECT path, seq, end_seq FROM new",
    **dict.fromkeys(("committed_files", "published_batches", "stream_committed_files"), _T.rstrip() + f", l AS (SELECT path, seq, coalesce(value, '') || chr(10) AS line FROM new), {_CHUNKS} SELECT path, chunk, start, content FROM files"),
    "route_counts": _M[:-2] + f" SELECT {_SAFE} AS route, count(*) AS n FROM m GROUP BY 1",
    "validate_jsonl": _M[:-2] + " SELECT seq, CASE WHEN seq % 31 = 0 THEN 'not a JSON object' WHEN seq % 37 = 0 THEN 'missing offset; unknown field' WHEN seq % 41 = 0 THEN 'value_encoding unknown' WHEN seq % 43 = 0 THEN 'type of partition' ELSE '' END AS reasons FROM m",
    "stream_pipeline": _jsonl() + f"SELECT seq, line || chr(10) AS payload FROM line WHERE {_ALLOWED}",
    "stream_transactions": _T + "SELECT seq, transactional_id, topic, value FROM com",
}
