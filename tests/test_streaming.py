"""Transactions in keyed state: expiry as a whole, bounded memory, and captured lines and recorded topics as streams."""

import random
import resource
import time

import pytest
from pyspark.sql import functions as F

from tidewire.functions import render as R
from tidewire.operators import transactions as T
from tidewire.operators.validate import validate_jsonl
from tidewire.sources import messages as M
from tidewire.sources.recorded import RecordedTopic, record
from tidewire.streaming import pipeline

LOG = "seq long, transactional_id string, kind string, topic string, value string, claimed_pid long, claimed_epoch int, is_commit boolean, assigned_pid long"


@pytest.fixture
def rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


def resolve(spark, top, rows, ttl_ms=None):
    """Append rows to the source, run the stream over what is new, and say which seq it has released so far."""
    source, out, state = (str(top / x) for x in ("in", "out", "state"))
    if rows:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(LOG).parquet(source)
    resolved = pipeline.resolve_transactions_stream(stream, ttl_ms)
    write = resolved.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    if ttl_ms is None:
        write.trigger(availableNow=True).start().awaitTermination()
    else:  # as long as there may be timers, Spark has another micro-batch to run
        query = write.trigger(processingTime="100 milliseconds").start()
        until = time.time() + (60 if rows else 4)
        while time.time() < until and not (rows and sum(p["numInputRows"] for p in query.recentProgress) >= len(rows)):
            time.sleep(0.2)
        query.stop()
    return sorted((r.seq, r.end_seq) for r in spark.read.schema(pipeline.RESOLVED).parquet(out).collect())


def init(q, pid, tid="t"):
    return (q, tid, "INIT", None, None, None, None, None, pid)


def ask(q, kind, epoch=0, commit=None, pid=1, tid="t"):
    return (q, tid, kind, None, None, pid, epoch, commit, None)


def msg(q, tid="t"):
    return (q, tid, "MSG", "x", str(q), None, None, None, None)


def test_an_expired_transaction_goes_as_a_whole(rocksdb, tmp_path):
    resolve(rocksdb, tmp_path, [init(0, 1), ask(1, "ADD"), msg(2), msg(3)], ttl_ms=1500)
    resolve(rocksdb, tmp_path, [], ttl_ms=1500)  # time passes
    assert resolve(rocksdb, tmp_path, [msg(5), ask(6, "END", commit=True), ask(7, "ADD"), msg(8), ask(9, "END", commit=True)], ttl_ms=1500) == [(8, 9)]


def test_rows_in_time_keep_a_transaction(rocksdb, tmp_path):
    resolve(rocksdb, tmp_path, [init(0, 1), ask(1, "ADD"), msg(2)], ttl_ms=60_000)
    resolve(rocksdb, tmp_path, [msg(3)], ttl_ms=60_000)
    assert resolve(rocksdb, tmp_path, [ask(4, "END", commit=True)], ttl_ms=60_000) == [(2, 4), (3, 4)]


def test_a_new_session_after_expiry(rocksdb, tmp_path):
    resolve(rocksdb, tmp_path, [init(0, 1), ask(1, "ADD"), msg(2)], ttl_ms=500)
    resolve(rocksdb, tmp_path, [], ttl_ms=500)
    assert resolve(rocksdb, tmp_path, [msg(4), init(5, 1), ask(6, "ADD", 1), msg(7), ask(8, "END", 1, True)], ttl_ms=500) == [(7, 8)]


def test_chunks_keep_rows_behind_a_terminal(rocksdb, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "CHUNK", 4)
    rng = random.Random(2)
    rows = [init(0, 1), ask(1, "ADD"), *map(msg, range(2, 30)), ask(30, "END", commit=False), *map(msg, range(31, 57)), ask(57, "END", commit=True), *map(msg, range(58, 61))]
    for some in (rows[:20], rows[20:]):
        rng.shuffle(some)
        found = resolve(rocksdb, tmp_path, some)
    assert found == [(k, 57) for k in range(31, 57)]


def test_a_million_pending_rows_in_order(rocksdb, tmp_path):
    """They go through a task's state and leave it in order; no worker holds them."""
    n = 1_000_000
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    known = "CASE WHEN id = 0 THEN 'INIT' WHEN id = 1 THEN 'ADD' WHEN id = {} THEN 'END' ELSE 'MSG' END".format(n)
    log = rocksdb.range(n + 1).selectExpr("id AS seq", "'hot' AS transactional_id", f"{known} AS kind", "'t' AS topic", "repeat('v', 100) AS value", "CAST(1 AS LONG) AS claimed_pid", "0 AS claimed_epoch", "true AS is_commit", "CAST(1 AS LONG) AS assigned_pid")
    log.repartition(8).write.parquet(source)
    seen = []

    def keep(df, _):
        order = df.withColumn("k", F.monotonically_increasing_id())
        seen.append(order.agg(F.count("*"), F.min("seq"), F.max("seq"), F.corr("k", "seq")).first())

    stream = rocksdb.readStream.schema(log.schema).parquet(source)
    pipeline.resolve_transactions_stream(stream).writeStream.foreachBatch(keep).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    (count, low, high, corr), = (tuple(x) for x in seen if x[0])
    assert (count, low, high) == (n - 2, 2, n - 1) and corr == pytest.approx(1.0)
    assert resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss < 8 << 20  # KB, with the JVM


class Held:
    """State in memory that counts what is written to it."""

    def __init__(self):
        self.rows, self.written, self.value = {}, 0, None

    def getValueState(self, *_):
        return self

    def getMapState(self, *_):
        return self

    def exists(self):
        return self.value is not None if not self.rows else True

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def keys(self):
        return iter(list(self.rows))

    def getValue(self, key):
        return self.rows[key]

    def updateValue(self, key, value):
        self.rows[key], self.written = value, self.written + 1

    def removeKey(self, key):
        del self.rows[key]

    def clear(self):
        self.rows.clear()


def test_state_is_written_once_for_what_outlasts_a_batch(monkeypatch):
    """Rows of an id that lie far apart in the log took a run of state each."""
    row = lambda r: dict(zip((f.split()[0] for f in LOG.split(", ")), r, strict=True))
    state, resolver = Held(), pipeline.TransactionResolver()
    resolver.init(state)
    far = [init(0, 1), ask(10_000, "ADD"), *(msg(k * 10_000) for k in range(2, 40)), ask(400_000, "END", commit=True), *(msg(k * 10_000) for k in range(41, 60))]
    found = list(resolver.handleInputRows(("t",), iter(map(row, far)), None))
    assert [r.seq for r in found] == [k * 10_000 for k in range(2, 40)]
    assert state.written == 1 and len(state.rows) == 1
    monkeypatch.setattr(pipeline, "BUFFER", 7)
    monkeypatch.setattr(pipeline, "CHUNK", 3)
    more = [ask(600_000, "ADD"), *(msg(k * 10_000) for k in range(61, 100)), ask(1_000_000, "END", commit=True), msg(1_000_001)]
    random.Random(1).shuffle(more)
    found = list(resolver.handleInputRows(("t",), iter(map(row, more)), None))
    assert [r.seq for r in found] == [k * 10_000 for k in range(41, 100) if k != 60]
    assert [r[0] for rows, in state.rows.values() for r in rows] == [1_000_001]


def test_a_batch_goes_through_state_once(rocksdb, tmp_path, monkeypatch):
    """What the sink gets, it may read again; it got the stateful plan itself, and read it twice."""
    plans = []

    class Sink:
        def write(self, df, batch_id):
            plans.append(df._jdf.queryExecution().toString())

    monkeypatch.setattr(pipeline, "open_sink", lambda *_, **__: Sink())
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    rocksdb.createDataFrame([init(0, 1), ask(1, "ADD"), msg(2), ask(3, "END", commit=True)], LOG).write.parquet(source)
    log = rocksdb.readStream.schema(LOG).parquet(source)
    pipeline.run_transactions(log, "out/{topic}/{txnID}.log", str(tmp_path / "table"), state, lambda df: df).awaitTermination()
    assert plans and not any("TransformWithState" in p for p in plans)


def test_captured_lines_as_a_stream(spark, tmp_path):
    good = '{"topic":"t","partition":1,"offset":%d,"value":"v","value_encoding":"utf-8","client_addr":"c"}'
    lines = [good % k if k % 3 else ("oops", '{"topic":1}', "")[k // 3 % 3] for k in range(30)]
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.jsonl").write_text("\n".join(lines[10 * k : 10 * k + 10]) + "\n")
    for _ in range(2):  # the second run finds nothing new
        M.capture_jsonl(M.stream_jsonl(spark, str(tmp_path / "in"), maxFilesPerTrigger=1), str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "state")).awaitTermination()
    from tidewire.sinks.published import read_published

    batch = M.read_jsonl(spark, str(tmp_path / "in"))
    checked = validate_jsonl(spark.read.text(str(tmp_path / "in")).withColumnRenamed("value", "line"))
    kept, refused = read_published(spark, str(tmp_path / "good")), read_published(spark, str(tmp_path / "bad"))
    assert kept.columns == batch.columns
    assert sorted(r.offset for r in kept.collect()) == [k for k in range(30) if k % 3] == sorted(r.offset for r in batch.where("client_addr IS NOT NULL").collect())
    assert sorted(map(tuple, refused.collect())) == sorted(map(tuple, checked.where(F.size("reasons") > 0).select("line", "reasons").collect()))


def recorded(spark, top, offsets):
    """Record the messages of given offsets by partition."""
    rows = [(p, o, f"k{o}".encode(), None if o % 7 == 0 else f"{p}/{o}".encode(), [("h", b"1"), ("h", b"2")] if o % 2 else None) for p, some in offsets.items() for o in some]
    schema = "partition int, offset long, key binary, value binary, headers array<struct<key:string,value:binary>>"
    record(spark.createDataFrame(rows, schema).withColumns({"topic": F.lit("clicks"), "timestamp": F.lit("2024-05-06 07:08:09").cast("timestamp")}), top)


def test_a_recorded_topic_as_a_stream(spark, tmp_path):
    """Micro-batches by offsets of each partition; a restart neither loses nor repeats."""
    spark.dataSource.register(RecordedTopic)
    top, out, state = (str(tmp_path / x) for x in ("topic", "out", "state"))
    start = lambda: M.from_kafka(spark.readStream.format("recorded_topic").load(top)).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    recorded(spark, top, {0: range(10), 1: range(3)})
    start()
    first = spark.read.parquet(out)
    assert sorted((r.partition, r.offset) for r in first.collect()) == [(p, o) for p, n in ((0, 10), (1, 3)) for o in range(n)]
    recorded(spark, top, {1: range(3, 9), 2: range(2)})
    start()
    start()
    found = spark.read.parquet(out)
    assert sorted((r.partition, r.offset) for r in found.collect()) == [(p, o) for p, n in ((0, 10), (1, 9), (2, 2)) for o in range(n)]
    row = found.where("partition = 1 AND offset = 7").first()
    assert (row.topic, bytes(row.key), row.value, row.tombstone, row.headers, row.client_addr) == ("clicks", b"k7", None, True, {"h": "2"}, "")
    batch = M.from_kafka(spark.read.format("recorded_topic").load(top))
    assert sorted(map(str, batch.collect())) == sorted(map(str, found.collect()))
    assert R.render(batch, "jsonl").count() == 21
