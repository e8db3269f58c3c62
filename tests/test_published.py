"""Published tables: replacement by path, replays, compaction, and streams that are killed and come again."""

import pytest
from pyspark.sql import functions as F

from tidewire.operators import transactions as T
from tidewire.sinks import published
from tidewire.sinks.files import open_sink
from tidewire.sinks.published import compact, publish, read_published, vacuum
from tidewire.streaming import pipeline

ROWS = "seq long, topic string, transactional_id string, payload binary, end_seq long"
PATTERN = "out/{topic}/{txnID}.log"


def rows(spark, *some):
    return spark.createDataFrame([(q, t, x, bytearray(p.encode()), e) for q, t, x, p, e in some], ROWS)


def shown(spark, table):
    return sorted((r.path, r.seq, bytes(r.payload).decode()) for r in read_published(spark, table).collect())


def test_a_later_commit_of_a_path_replaces_the_earlier(spark, tmp_path):
    table = str(tmp_path)
    sink = open_sink(PATTERN, transactional=True, table=table)
    old = rows(spark, (1, "t", "x", "old", 3), (2, "t", "x", "old", 3), (2, "u", "x", "other", 3))
    new = rows(spark, (5, "t", "x", "new", 6))
    sink.write(old, 0)
    sink.write(new, 1)
    wanted = [("out/t/x.log", 5, "new"), ("out/u/x.log", 2, "other")]
    assert shown(spark, table) == wanted
    sink.write(old, 0)  # a replay of the older batch
    assert shown(spark, table) == wanted
    sink.write(rows(spark, (5, "t", "x", "newer", 6)), 1)  # a replay that differs takes its batch's place
    assert shown(spark, table)[0] == ("out/t/x.log", 5, "newer")
    sink.write(old.limit(0), 2)
    assert len(shown(spark, table)) == 2


def test_the_newest_commit_within_a_batch(spark, tmp_path):
    open_sink(PATTERN, transactional=True, table=str(tmp_path)).write(rows(spark, (1, "t", "x", "a", 3), (4, "t", "x", "b", 5), (2, "u", "x", "c", 3)), 0)
    assert shown(spark, str(tmp_path)) == [("out/t/x.log", 4, "b"), ("out/u/x.log", 2, "c")]


def test_what_is_staged_is_not_shown(spark, tmp_path, monkeypatch):
    table = str(tmp_path)
    df = rows(spark, (1, "t", "x", "a", 3)).withColumn("path", F.lit("p"))
    publish(df, table, 0)
    with monkeypatch.context() as m:
        m.setattr(published, "_enter", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            publish(df.withColumn("payload", F.lit(b"b")), table, 1)
    assert [x[2] for x in shown(spark, table)] == ["a"]
    vacuum(spark, table)
    assert len(list((tmp_path / "data").glob("name=*"))) == 1
    assert [x[2] for x in shown(spark, table)] == ["a"]


def test_compaction_keeps_what_is_shown(spark, tmp_path):
    table = str(tmp_path)
    batch = lambda k: rows(spark, (k, "t", f"x{k % 3}", str(k), k)).withColumn("path", F.lit(f"p{k % 3}"))
    for k in range(5):
        publish(batch(k), table, k)
    before = shown(spark, table)
    assert [x[2] for x in before] == ["3", "4", "2"]
    compact(spark, table)
    vacuum(spark, table)
    assert shown(spark, table) == before and len(list((tmp_path / "data").glob("name=*"))) == 1
    publish(batch(4).withColumn("payload", F.lit(b"again")), table, 4)  # part of the base by now
    assert shown(spark, table) == before
    publish(batch(5), table, 5)
    compact(spark, table)
    assert [x[2] for x in shown(spark, table)] == ["3", "4", "5"]


def test_rows_without_paths_stand_beside_one_another(spark, tmp_path):
    for k in (0, 1, 1):
        publish(spark.createDataFrame([(k,)], "seq long"), str(tmp_path), k)
    compact(spark, str(tmp_path))
    assert sorted(r.seq for r in read_published(spark, str(tmp_path)).collect()) == [0, 1]
    with pytest.raises(ValueError, match="nothing is published"):
        read_published(spark, str(tmp_path / "none"))


LOG = "seq long, transactional_id string, kind string, topic string, value string, claimed_pid long, claimed_epoch int, is_commit boolean, assigned_pid long"


def log_rows():
    """Transactions of three ids, some of which span thirds of the log and write one path again."""
    out, pids = [], {}
    for k in range(90):
        tid = f"t{k % 3}"
        step = (k // 3) % 10
        if k < 3:
            pids[tid] = k + 1
            out.append((k, tid, "INIT", None, None, None, None, None, pids[tid]))
        elif step in (1, 7):
            out.append((k, tid, "ADD", None, None, pids[tid], 0, None, None))
        elif step in (6, 9):
            out.append((k, tid, "END", None, None, pids[tid], 0, k % 2 == 0, None))
        else:
            out.append((k, tid, "MSG", "a" if step % 2 else "b", f"{k}\n", None, None, None, None))
    return out


def start(spark, source, table, state):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(source)
    pipeline.run_transactions(stream, PATTERN, table, state, lambda df: df.withColumn("payload", F.col("value"))).awaitTermination()


def test_a_stream_killed_between_data_and_manifest(spark, tmp_path, monkeypatch):
    source, table, state = (str(tmp_path / x) for x in ("in", "table", "state"))
    log = spark.createDataFrame(log_rows(), LOG)
    for k in range(3):
        log.where(f"seq DIV 30 = {k}").coalesce(1).write.mode("append").parquet(source)
    enter, calls = published._enter, []

    def once_killed(*args):
        calls.append(args[2])
        if len(calls) == 2:
            raise OSError("killed")
        enter(*args)

    monkeypatch.setattr(published, "_enter", once_killed)
    with pytest.raises(Exception, match="killed"):
        start(spark, source, table, state)
    start(spark, source, table, state)
    assert calls == [0, 1, 1, 2]
    committed = T.committed_messages(log).withColumn("payload", F.col("value").cast("binary"))
    open_sink(PATTERN, transactional=True, table=str(tmp_path / "batch")).write(committed)
    assert shown(spark, table) == shown(spark, str(tmp_path / "batch")) != []
