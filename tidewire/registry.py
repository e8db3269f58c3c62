"""Registered queries over the driver's tables, and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import render as R
from tidewire.functions.paths import resolve_path, safe_segment
from tidewire.operators import messages as M
from tidewire.operators import transactions as T
from tidewire.operators.validate import validate_jsonl
from tidewire.plans.adapters import ALLOWED, event_log, messages
from tidewire.plans.oracles import ORACLES
from tidewire.session import materialise, scratch
from tidewire.sinks.files import open_sink, write_by_topic
from tidewire.sinks.published import publish, read_published
from tidewire.sources.messages import event_log as union_log
from tidewire.sources.messages import parse_jsonl
from tidewire.streaming.pipeline import resolve_transactions_stream, run_pipeline, run_transactions

__all__ = ["ORACLES", "QUERIES"]

TEMPLATE = "at %T: %t/%p@%o\\t<%K>%k=<%S>%s%%\\n"
URL = "http://collector.example/in"
PATH = "out/{topic}/{txnID}.log"
#: Small, so that files of the given tables have several.
CHUNK_BYTES = 256


def _plain(df: DataFrame) -> DataFrame:
    return df.select("seq", "request_id", "topic", F.col("partition").alias("part"), F.col("offset").alias("off"), F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"), F.size("headers").alias("n_headers"), F.unix_millis("timestamp").alias("ts_ms"), "tombstone", "client_addr", "transactional_id")


def _payload(df: DataFrame) -> DataFrame:
    return df.select("seq", F.col("payload").cast("string").alias("payload"))


def _rendered(fmt: str, **options):
    return lambda s, d: _payload(R.render(messages(s, d), fmt, **options))


def log_union(s: SparkSession, d: str) -> DataFrame:
    log = event_log(s, d)
    return union_log(log.where("kind = 'MSG'").select("seq", "transactional_id", "topic", "value"), log.where("kind <> 'MSG'").select("seq", "transactional_id", "kind", "claimed_pid", "claimed_epoch", "is_commit")).select("seq", "transactional_id", "kind", "claimed_pid", "claimed_epoch", "is_commit")


def roundtrip(s: SparkSession, d: str) -> DataFrame:
    lines = R.render(messages(s, d), "jsonl", key_base64=True).select(F.col("payload").cast("string").alias("line"))
    return parse_jsonl(lines).select("topic", F.col("partition").alias("part"), F.col("offset").alias("off"), F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"), F.unix_millis("timestamp").alias("ts_ms"), "client_addr")


def validated(s: SparkSession, d: str) -> DataFrame:
    line = F.rtrim(F.col("payload").cast("string"), F.lit("\n"))
    seq = F.col("seq")
    broken = F.when(seq % 31 == 0, "oops").when(seq % 37 == 0, F.replace(line, F.lit('"offset"'), F.lit('"offst"'))).when(seq % 41 == 0, F.replace(line, F.lit('"value_encoding":"utf-8"'), F.lit('"value_encoding":"rot13"'))).when(seq % 43 == 0, F.regexp_replace(line, '"partition":(\\d+)', '"partition":"$1"')).otherwise(line)
    lines = R.render(messages(s, d), "jsonl").select("seq", broken.alias("line"))
    return validate_jsonl(lines).select("seq", F.array_join("reasons", "; ").alias("reasons"))


def requests(s: SparkSession, d: str) -> DataFrame:
    return R.http_request(R.render(messages(s, d), "binary"), URL)


def request_rows(s: SparkSession, d: str) -> DataFrame:
    entries = F.transform(F.array_sort(F.map_entries("http_headers")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return requests(s, d).select("seq", "url", F.hex("body").alias("body_hex"), F.array_join(entries, "\n").alias("headers"))


def _committed(s: SparkSession, d: str) -> DataFrame:
    rows = T.committed_messages(event_log(s, d))
    return rows.withColumn("path", resolve_path(PATH, F.col("topic"), F.col("transactional_id")))


def _files(published: DataFrame) -> DataFrame:
    return M.assemble_files(published, CHUNK_BYTES).select("path", "chunk", "start", F.col("content").cast("string").alias("content"))


def committed_files(s: SparkSession, d: str) -> DataFrame:
    """Flagship: resolve the log, publish what is committed at once, the newest commit of each path, and show the files' chunks."""
    table = scratch(s, "published")
    committed = T.committed_messages(event_log(s, d))
    open_sink(PATH, transactional=True, table=table).write(committed.withColumn("payload", R.binary()))
    return _files(read_published(s, table))


def published_batches(s: SparkSession, d: str) -> DataFrame:
    """As committed_files, but transactions that end in the first half of the log are one batch, the others the next, and then the first is replayed."""
    table = scratch(s, "published")
    committed = materialise(T.committed_messages(event_log(s, d)).withColumn("payload", R.binary()), "committed")
    sink = open_sink(PATH, transactional=True, table=table)
    early = F.col("end_seq") < (committed.agg(F.max("end_seq")).first()[0] or 0) / 2
    for batch, rows in ((0, committed.where(early)), (1, committed.where(~early)), (0, committed.where(early))):
        sink.write(rows, batch)
    return _files(read_published(s, table))


def stream_committed_files(s: SparkSession, d: str) -> DataFrame:
    """As committed_files, from a stream of several micro-batches: resolved in state, published batch by batch."""
    table, state = scratch(s, "published"), scratch(s, "state")
    _rocksdb(s)
    run_transactions(_in_batches(s, event_log(s, d)), PATH, table, state, lambda df: df.withColumn("payload", R.binary())).awaitTermination()
    return _files(read_published(s, table))


def _rocksdb(s: SparkSession) -> None:
    s.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _in_batches(s: SparkSession, log: DataFrame) -> DataFrame:
    """The log as a stream of three micro-batches, one behind the other in order of seq; files of a later one are younger."""
    source = scratch(s, "in")
    last = log.agg(F.max("seq")).first()[0] or 0
    for k in range(3):
        part = F.least(F.floor(3 * F.col("seq") / (last + 1)), F.lit(2))
        log.where(part == k).repartition(4).write.mode("append").parquet(source)
    return s.readStream.schema(log.schema).option("maxFilesPerTrigger", 4).parquet(source)


def collisions(s: SparkSession, d: str) -> DataFrame:
    raw = messages(s, d).select(F.col("topic").alias("raw"), safe_segment(F.col("topic")).alias("path"))
    return M.path_collisions(raw).select("path", F.array_join("names", ",").alias("names"))


def files(s: SparkSession, d: str) -> DataFrame:
    df = R.render(messages(s, d), "template", text="%o:%s\\n").withColumn("path", resolve_path("out/{topic}.log", F.col("topic")))
    return M.assemble_files(df, CHUNK_BYTES).select("path", "chunk", "start", F.sha2("content", 256).alias("content_sha256"), F.octet_length("content").cast("long").alias("n_bytes"))


def stream_pipeline(s: SparkSession, d: str) -> DataFrame:
    source, out, state = scratch(s, "in"), scratch(s, "out"), scratch(s, "state")
    rows = messages(s, d)
    rows.write.parquet(source)
    stream = s.readStream.schema(s.read.parquet(source).schema).parquet(source)
    run_pipeline(stream, ALLOWED, "jsonl", lambda df, k: publish(df.select("seq", "payload"), out, k), state).awaitTermination()
    return _payload(read_published(s, out))


def routes(s: SparkSession, d: str) -> DataFrame:
    """Lines that the sink by topic has written for each route."""
    out = scratch(s, "routes")
    write_by_topic(R.render(messages(s, d), "jsonl"), out)
    return s.read.text(out).groupBy("route").agg(F.count("*").alias("n"))


def stream_transactions(s: SparkSession, d: str) -> DataFrame:
    out, state = scratch(s, "out"), scratch(s, "state")
    _rocksdb(s)
    resolved = resolve_transactions_stream(_in_batches(s, event_log(s, d)))
    resolved.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return s.read.parquet(out).select("seq", "transactional_id", "topic", F.col("value").cast("string").alias("value"))


QUERIES = {
    "messages": lambda s, d: _plain(messages(s, d)),
    "headers_last_wins": lambda s, d: messages(s, d).select("seq", F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("headers")),
    "event_log": log_union,
    "jsonl_roundtrip": roundtrip,
    "filter_topics": lambda s, d: M.filter_topics(messages(s, d), ALLOWED).select("seq", "topic"),
    "rejected_topics": lambda s, d: M.rejected_topics(messages(s, d), ALLOWED).select("seq", "topic", "error_code"),
    "tombstones": lambda s, d: M.split_tombstones(messages(s, d))[1].select("seq", "topic", "tombstone"),
    "non_transactional": lambda s, d: M.require_transactional(messages(s, d))[1].select("seq", "topic"),
    "render_binary": lambda s, d: R.render(messages(s, d), "binary", after=R.separator("\\r\\n")).select("seq", F.hex("payload").alias("payload_hex")),
    "render_jsonl": _rendered("jsonl"),
    "render_jsonl_b64key": _rendered("jsonl", key_base64=True),
    "render_jsonl_b64value": _rendered("jsonl", value_base64=True),
    "render_template": _rendered("template", text=TEMPLATE),
    "topic_id": lambda s, d: messages(s, d).select("seq", F.lower(F.hex(R.topic_id(F.col("topic")))).alias("topic_id")),
    "safe_segment": lambda s, d: messages(s, d).select("seq", safe_segment(F.col("topic")).alias("segment")),
    "resolve_path": lambda s, d: messages(s, d).where("transactional_id IS NOT NULL").select("seq", resolve_path(PATH, F.col("topic"), F.col("transactional_id")).alias("path")),
    "http_request": request_rows,
    "produce_outcomes": lambda s, d: M.produce_outcomes(messages(s, d), ALLOWED).withColumnRenamed("partition", "part"),
    "request_batches": lambda s, d: M.request_batches(messages(s, d), ALLOWED),
    "assemble_files": files,
    "path_collisions": collisions,
    "producer_sessions": lambda s, d: T.producer_sessions(event_log(s, d)),
    "fence_checks": lambda s, d: T.fence_checks(event_log(s, d)),
    "zombie_aborts": lambda s, d: T.zombie_aborts(event_log(s, d)),
    "txn_terminals": lambda s, d: T.txn_terminals(event_log(s, d)),
    "txn_outcomes": lambda s, d: T.txn_outcomes(event_log(s, d)).drop("value"),
    "committed_messages": lambda s, d: T.committed_messages(event_log(s, d)).select("seq", "transactional_id", "topic", "value"),
    "aborted_messages": lambda s, d: T.txn_outcomes(event_log(s, d)).where("outcome <> 'COMMIT'").select("seq", "transactional_id", "outcome"),
    "latest_commit": lambda s, d: T.latest_commit(_committed(s, d)).select("path", "seq", "end_seq"),
    "committed_files": committed_files,
    "published_batches": published_batches,
    "stream_committed_files": stream_committed_files,
    "route_counts": routes,
    "validate_jsonl": validated,
    "stream_pipeline": stream_pipeline,
    "stream_transactions": stream_transactions,
}
