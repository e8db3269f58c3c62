"""Delivery over real HTTP, raw bytes, routes, and publishing as a whole."""

import os
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from tidewire.functions import render as R
from tidewire.sinks import http
from tidewire.sinks.files import RawSource, open_sink, split_pattern, write_by_topic, write_text
from tidewire.sinks.published import publish, read_published
from tidewire.sources.messages import MESSAGE
from tidewire.streaming.pipeline import run_pipeline

REQUEST = "seq long, url string, body binary, http_headers map<string,string>"
PAYLOADS = "seq long, topic string, transactional_id string, payload binary"


@pytest.fixture
def server():
    """A server on this machine that answers what `plan` has for the body and the attempt, and keeps what it got."""
    got, plan, inside, most = [], {}, [0], [0]

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            inside[0] += 1
            most[0] = max(most[0], inside[0])
            body = self.rfile.read(int(self.headers["content-length"]))
            got.append((body, {k.lower(): v for k, v in self.headers.items()}))
            status = plan.get(body, [200])[min(sum(b == body for b, _ in got), len(plan.get(body, [200]))) - 1]
            if status is None:
                self.wfile.write(b"this is no reply\r\n\r\n")
            else:
                self.send_response(status)
                self.send_header("content-length", "0")
                self.end_headers()
            inside[0] -= 1

        def log_message(self, *args):
            pass

    httpd = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}/in", got, plan, most
    httpd.shutdown()


def test_delivery_over_http(spark, server):
    url, got, plan, most = server
    plan |= {b"b1": [503, 200], b"b2": [204], b"b3": [500], b"b4": [None, 200]}
    rows = [(k, url, bytearray(f"b{k}".encode()), {"x-kafka-topic": "t", "x-kafka-offset": str(k)}) for k in range(5)]
    df = spark.createDataFrame(rows, REQUEST).coalesce(1)
    out = {r.seq: r for r in http.deliver(df, retries=1, delay=0).collect()}
    assert [(out[k].attempts, out[k].delivered) for k in range(5)] == [(1, True), (2, True), (2, False), (2, False), (2, True)]
    assert (out[2].last_error, out[3].status) == ("status 204", 500)
    assert [out[k].attempts for k in range(5)] == [1, 2, 2, 2, 2]
    assert [b for b, _ in got] == [b"b0", b"b1", b"b1", b"b2", b"b2", b"b3", b"b3", b"b4", b"b4"] and most[0] == 1
    assert got[0][1]["x-kafka-offset"] == "0" and got[0][1]["x-kafka-topic"] == "t"


def test_nobody_listens(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://127.0.0.1:9/", bytearray(b"x"), {})], REQUEST)
    with pytest.raises(RuntimeError, match="not delivered"):
        http.send(df, retries=-1, delay=0)
    http.send(df, dead_letters=str(tmp_path / "dead"), delay=0)
    assert [(r.seq, r.attempts, r.status, bytes(r.payload)) for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == [(1, 1, None, b"x")]


@pytest.fixture
def kept():
    """A server that keeps connections open: how many there were, and the bodies and raw headers that came."""
    connections, got = [], []

    class Handler(BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"

        def setup(self):
            connections.append(self)
            super().setup()

        def do_POST(self):  # noqa: N802
            got.append((self.rfile.read(int(self.headers["content-length"])), dict(self.headers.items())))
            self.send_response(200)
            self.send_header("content-length", "2")
            if got[-1][0] == b"last":
                self.send_header("connection", "close")
            self.end_headers()
            self.wfile.write(b"ok")

        def log_message(self, *args):
            pass

    httpd = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}/in?x=1", got, connections
    httpd.shutdown()


def test_one_connection_for_a_partition(spark, kept):
    url, got, connections = kept
    rows = [(k, url, bytearray(b"last" if k == 49 else f"{k}".encode()), {"x": str(k)}) for k in range(100)]
    out = http.deliver(spark.createDataFrame(rows, REQUEST).coalesce(1)).collect()
    assert all(r.delivered and r.attempts == 1 for r in out) and [h["x"] for _, h in got] == [str(k) for k in range(100)]
    assert len(connections) == 2  # the server closed one after row 49


def test_no_header_ends_the_task(spark, kept):
    url, got, _ = kept
    odd = [{"x-kafka-header-a": "日本"}, {"x-kafka-header-b": "a\r\nb"}, {"x-kafka-ü: ": "1"}, {"x-kafka-header-c": "é"}]
    rows = [(k, url, bytearray(b"v"), h) for k, h in enumerate(odd)] + [(9, "http://[bad", bytearray(b"v"), {})]
    out = {r.seq: r for r in http.deliver(spark.createDataFrame(rows, REQUEST).coalesce(1), retries=1, delay=0).collect()}
    assert [out[k].delivered for k in (0, 1, 2, 3, 9)] == [True, False, False, True, False]
    assert all(out[k].attempts == 2 and out[k].last_error for k in (1, 2, 9))
    sent = [v.encode("latin-1").decode() for _, h in got for k, v in h.items() if k.startswith("x-kafka")]
    assert sent == ["日本", "é"]


def test_a_task_tried_again_posts_no_answered_row_twice(spark, kept, tmp_path):
    url, got, _ = kept
    once = str(tmp_path / "failed")

    class Failing(http.Session):
        def __call__(self, url, body, headers):
            if body == b"7" and not os.path.exists(once):
                open(once, "w").close()
                raise RuntimeError("the task fails")
            return super().__call__(url, body, headers)

    rows = [(k, url, bytearray(f"{k}".encode()), {}) for k in range(20)]
    df = spark.createDataFrame(rows, REQUEST).coalesce(1)
    ledger = str(tmp_path / "ledger")
    with pytest.raises(Exception, match="the task fails"):  # a local session tries a task once
        http.send(df, transport=Failing, ledger=ledger, batch_id=4)
    assert [b for b, _ in got] == [f"{k}".encode() for k in range(7)]
    http.send(df, transport=Failing, ledger=ledger, batch_id=4)
    http.send(df, transport=Failing, ledger=ledger, batch_id=4)
    assert [b for b, _ in got] == [f"{k}".encode() for k in range(20)]
    http.send(df.limit(1), ledger=ledger, batch_id=5)
    assert len(got) == 21


def test_a_task_reads_its_own_outbox(spark, kept, tmp_path):
    url, got, _ = kept
    df = spark.createDataFrame([(k, url, bytearray(f"{k}".encode()), {}) for k in range(4)], REQUEST).coalesce(1)
    first = http.deliver(df, outbox=str(tmp_path)).collect()
    next((tmp_path / "000000").iterdir()).write_text(next((tmp_path / "000000").iterdir()).read_text() + '{"seq": 3, "att')
    assert http.deliver(df, outbox=str(tmp_path)).collect() == first and len(got) == 4


def test_http_sink(spark, server):
    url, got, _, _ = server
    df = spark.createDataFrame([("a", 3, 9, bytearray(b"k"), bytearray(b"v"), {"One": "1"}, None, False, "c", None)], MESSAGE).withColumn("seq", F.lit(1).cast("long"))
    open_sink(url, delay=0).write(R.render(df, "binary"))
    (body, headers), *_ = got
    assert body == b"v\n" and (headers["x-kafka-partition"], headers["x-kafka-key"], headers["x-kafka-header-one"]) == ("3", "aw==", "1")


def test_raw_bytes(spark, tmp_path):
    spark.dataSource.register(RawSource)
    df = spark.createDataFrame([(bytearray(b"\x00\xff"),), (bytearray(b"\n"),), (None,)], "payload binary").coalesce(1)
    for _ in range(2):
        df.write.format("raw_bytes").mode("append").save(str(tmp_path / "raw"))
    assert b"".join(p.read_bytes() for p in sorted((tmp_path / "raw").iterdir())) == 2 * b"\x00\xff\n"


def test_raw_bytes_leave_nothing_of_a_failed_write(spark, tmp_path):
    spark.dataSource.register(RawSource)
    broken = spark.range(20).select(F.when(F.col("id") < 15, F.lit(b"x")).otherwise(F.raise_error(F.lit("broken")).cast("binary")).alias("payload")).repartition(3)
    with pytest.raises(Exception, match="broken"):
        broken.write.format("raw_bytes").mode("append").save(str(tmp_path / "raw"))
    assert not (tmp_path / "raw").exists() or not list((tmp_path / "raw").iterdir())


def test_raw_bytes_of_a_stream(spark, tmp_path):
    spark.dataSource.register(RawSource)
    spark.createDataFrame([(bytearray(b"a\0"),), (bytearray(b"b"),)], "payload binary").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("payload binary").parquet(str(tmp_path / "in"))
    for state in ("one", "two"):  # the second run replays the batch
        stream.writeStream.format("raw_bytes").option("checkpointLocation", str(tmp_path / state)).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("batch-*"))) == b"a\0b"


def test_a_commit_of_raw_bytes_lists_no_other_batch(tmp_path, monkeypatch):
    from pyarrow import fs

    from tidewire.sinks.files import RawStreamWriter

    writer = RawStreamWriter(str(tmp_path / "out"), ["route", "payload"])
    for k in range(30):
        writer.commit([writer.write([("a/b", bytearray(f"{k};".encode()))]), None], k)
    monkeypatch.setattr(fs, "FileSelector", lambda *a, **b: (_ for _ in ()).throw(AssertionError("listed")))
    writer.commit([writer.write([("a/b", bytearray(b"new;")), ("c", bytearray(b"x"))])], 29)
    writer.abort([writer.write([("a/b", bytearray(b"gone"))])], 30)
    monkeypatch.undo()
    assert b"".join(p.read_bytes() for p in sorted((tmp_path / "out/a/b").iterdir())) == b"".join(f"{k};".encode() for k in range(29)) + b"new;"
    assert [p.read_bytes() for p in (tmp_path / "out/c").iterdir()] == [b"x"]


def test_text_is_verbatim(spark, tmp_path):
    df = spark.createDataFrame([(1, bytearray(b"a\n\n\n")), (2, None), (3, bytearray(b"\xff\n"))], "seq long, payload binary").coalesce(1)
    write_text(df, str(tmp_path / "out"))
    write_text(df, str(tmp_path / "out"))
    assert sorted(p.read_bytes() for p in (tmp_path / "out").glob("part-*.txt")) == 2 * [b"a\n\n\n\xff\n"]
    with pytest.raises(Exception, match="does not end in a newline"):
        write_text(spark.createDataFrame([(1, bytearray(b"a"))], "seq long, payload binary"), str(tmp_path / "other"))


def test_routes_hold_the_bytes_in_order(spark, tmp_path):
    rows = [(k, ("../up", "t", "a/b")[k % 3], None, bytearray(f"{k}\n".encode())) for k in range(60)]
    df = spark.createDataFrame(rows, PAYLOADS).repartition(5)
    write_by_topic(df, str(tmp_path / "routes"))
    open_sink(f"{tmp_path}/raw/x-{{topic}}.log").write(df)
    want = {n: b"".join(f"{k}\n".encode() for k in range(60) if k % 3 == r) for r, n in enumerate(("up", "t", "b"))}
    held = lambda top: b"".join(p.read_bytes() for p in sorted(top.glob("part-*")))
    assert {p.name: held(p) for p in (tmp_path / "routes").iterdir() if p.is_dir()} == {f"route={n}": x for n, x in want.items()}
    assert {p.name: held(p) for p in (tmp_path / "raw").iterdir()} == {f"x-{n}.log": x for n, x in want.items()}
    open_sink(f"{tmp_path}/one").write(df)
    assert held(tmp_path / "one") == b"".join(f"{k}\n".encode() for k in range(60))


def test_patterns(spark, tmp_path):
    df = spark.createDataFrame([(1, "../clicks", None, bytearray(b"c;")), (2, "views", None, bytearray(b"v;"))], PAYLOADS)
    held = lambda: {str(p.parent.relative_to(tmp_path)): p.read_bytes() for p in tmp_path.rglob("part-*")}
    for pattern in ("{topic}/{topic}.log", "deep/x-{topic}/y/{topic}-{topic}", "{topic}.log"):
        open_sink(f"{tmp_path}/{pattern}").write(df)
    assert held() == {w.replace("T", t): b for t, b in (("clicks", b"c;"), ("views", b"v;")) for w in ("T/T.log", "deep/x-T/y/T-T", "T.log")}
    assert [split_pattern(x) for x in ("{topic}.log", "/{topic}", "a/b-{topic}/c/{topic}", "s3a://x/{topic}")] == [("", "{topic}.log"), ("/", "{topic}"), ("a", "b-{topic}/c/{topic}"), ("s3a://x", "{topic}")]


def test_published_whole_or_not_at_all(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "t", "x/1", bytearray(b"a")), (2, "u", "x/1", bytearray(b"b"))], PAYLOADS)
    sink = open_sink("out/{topic}/{txnID}.log", transactional=True, table=out)
    for k in (7, 7, 8):
        sink.write(df, k)
    assert sorted((r.path, r.seq) for r in read_published(spark, out).collect()) == [("out/t/1.log", 1), ("out/u/1.log", 2)]
    broken = df.withColumn("payload", F.when(F.col("seq") == 1, F.col("payload")).otherwise(F.raise_error(F.lit("broken")).cast("binary")))
    with pytest.raises(Exception, match="broken"):
        publish(broken, out, 9)
    assert read_published(spark, out).count() == 2
    publish(df.limit(0).withColumn("path", F.lit("")), out, 10)  # an empty commit changes nothing
    assert read_published(spark, out).count() == 2


def test_open_sink():
    assert [open_sink(x).kind for x in ("-", "https://a/b", "out/{topic}.log", "out.log", "s3a://b/c")] == ["console", "http", "pattern", "path", "path"]
    assert open_sink("{txnID}", transactional=True, table="t").kind == "pattern"
    for dst, transactional, said in (("ftp://a/b", False, "unsupported"), ("-", True, "published to"), ("http://a", True, "published to"), ("out.log", True, "txnID"), ("{topic}", True, "txnID"), ("{txnID}", True, "table"), ("x/{txnID}.log", False, "outside transactions")):
        with pytest.raises(ValueError, match=said):
            open_sink(dst, transactional)


def test_an_error_stops_the_stream_and_the_batch_comes_again(spark, tmp_path):
    rows = [("click", 0, k, None, bytearray(b"v"), {}, None, False, "c", None) for k in range(5)]
    spark.createDataFrame(rows, MESSAGE).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    seen = []

    def write(df, k):
        seen.append((k, df.count()))
        if len(seen) == 1:
            raise OSError("disk full")

    start = lambda: run_pipeline(stream, ["click"], "binary", write, str(tmp_path / "state")).awaitTermination()
    with pytest.raises(Exception, match="disk full"):
        start()
    start()
    start()
    assert seen == [(0, 5), (0, 5)]
