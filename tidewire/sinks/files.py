"""File sinks: text, raw bytes, one output per topic, and what a destination opens."""

from __future__ import annotations

import contextlib
import json
import time
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from tidewire.functions.paths import resolve_path, safe_segment
from tidewire.operators.transactions import latest_commit
from tidewire.sinks.published import publish


def _line() -> Column:
    """A payload without the one newline at its end, which the text sink adds again."""
    ends = F.expr("right(payload, 1) = X'0A'")
    body = F.expr("substring(payload, 1, octet_length(payload) - 1)").cast("string")
    return F.when(ends, body).otherwise(F.raise_error(F.lit("a payload does not end in a newline: use the raw_bytes sink")))


def write_text(df: DataFrame, path: str, mode: str = "append") -> None:
    """Payloads byte by byte, for those that end in a newline; another one is an error. Null payloads are left out."""
    df.where("payload IS NOT NULL").select(_line().alias("value")).write.mode(mode).text(path)


def in_order(df: DataFrame, route: Column) -> DataFrame:
    """df with `route`, dealt by ranges of route and seq: files follow one another in order, and a large route has several."""
    return df.withColumn("route", route).repartitionByRange("route", "seq").sortWithinPartitions("route", "seq")


def write_by_topic(df: DataFrame, path: str, mode: str = "append") -> None:
    """Payloads under route=<safe topic>, byte by byte, in order of seq. As write_text otherwise."""
    routed = in_order(df.where("payload IS NOT NULL"), safe_segment(F.col("topic")))
    routed.select("route", _line().alias("value")).write.mode(mode).partitionBy("route").text(path)


class RawSource(DataSource):
    """Payload bytes verbatim, batch or stream: df.select("payload").write.format("raw_bytes").mode("append").save(path).

    With a column route before payload, each route is a folder. Nulls add nothing. The path is
    any that executors share and pyarrow opens.
    """

    @classmethod
    def name(cls) -> str:
        return "raw_bytes"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return RawWriter(self.options["path"], schema.names)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return RawStreamWriter(self.options["path"], schema.names)


class Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, str]]):
        self.files = files


class _Raw:
    """Tasks write hidden files; the driver names them when all are there, or removes them."""

    def __init__(self, path: str, columns: list[str]):
        self.path, self.routed = path, columns[0] == "route"

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def write(self, rows) -> WriterCommitMessage:
        store, top = self._open()
        files: list[tuple[str, str]] = []
        out = None
        try:
            for row in rows:
                route = row[0] if self.routed else ""
                if not files or files[-1][0] != route:
                    if out is not None:
                        out.close()
                    folder = f"{top}/{route}" if route else top
                    store.create_dir(folder, recursive=True)
                    files.append((route, f"{folder}/.{uuid.uuid4().hex}.tmp"))
                    out = store.open_output_stream(files[-1][1])
                out.write(bytes(row[-1] or b""))
            if out is not None:
                out.close()
        except BaseException:
            self._remove([Written(files)])
            raise
        return Written(files)

    def _named(self, messages, name: str) -> list[tuple[str, str]]:
        """(hidden file, name below the path) of all that tasks have written."""
        return [(file, f"{route + '/' if route else ''}{name}-{k:05d}-{n:05d}") for k, m in enumerate(messages) for n, (route, file) in enumerate(m.files if m is not None else ())]

    def _remove(self, messages) -> None:
        store, _ = self._open()
        for m in messages:
            for _, file in m.files if m is not None else ():
                with contextlib.suppress(OSError):
                    store.delete_file(file)


class RawWriter(_Raw, DataSourceWriter):
    def commit(self, messages) -> None:
        store, top = self._open()
        for file, name in self._named(messages, f"part-{time.time_ns():020d}"):
            store.move(file, f"{top}/{name}")

    def abort(self, messages) -> None:
        self._remove(messages)


class RawStreamWriter(_Raw, DataSourceStreamWriter):
    """A replayed micro-batch takes the place of what it wrote before.

    What a batch is to publish is first written to its own file in _commits, so that neither a
    commit nor a replay lists what other batches have written.
    """

    def commit(self, messages, batchId: int) -> None:  # noqa: N803
        from pyarrow import fs

        store, top = self._open()
        log = f"{top}/_commits/{batchId:010d}"
        if store.get_file_info(log).type != fs.FileType.NotFound:
            with store.open_input_stream(log) as f:
                for old in json.loads(f.read()):
                    with contextlib.suppress(OSError):  # one that did not come so far
                        store.delete_file(f"{top}/{old}")
        # Names of one attempt are its own, so a broken one is found and removed.
        moves = self._named(messages, f"batch-{batchId:010d}")
        store.create_dir(f"{top}/_commits", recursive=True)
        with store.open_output_stream(log) as f:
            f.write(json.dumps([name for _, name in moves]).encode())
        for file, name in moves:
            store.move(file, f"{top}/{name}")

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        self._remove(messages)


def split_pattern(pattern: str) -> tuple[str, str]:
    """(folder, rest): the folders of a pattern that have no placeholder, and what is left, which names a route of any depth."""
    start = pattern.index("{topic}")
    folder, slash, _ = pattern[:start].rpartition("/")
    return folder + slash if folder in ("", "/") or folder.endswith(":/") else folder, pattern[len(folder + slash) :]


class Sink:
    """Where payloads go: console, http, pattern or path; `write(df, batch_id)` suits foreachBatch."""

    def __init__(self, kind: str, dst: str, transactional: bool, options: dict):
        self.kind, self.dst, self.transactional, self.options = kind, dst, transactional, options

    def write(self, df: DataFrame, batch_id: int = 0) -> None:
        from tidewire.functions.render import http_request
        from tidewire.sinks import http

        if self.transactional:
            routed = df.withColumn("path", resolve_path(self.dst, F.col("topic"), F.col("transactional_id")))
            publish(latest_commit(routed) if "end_seq" in df.columns else routed, self.options["table"], batch_id)
        elif self.kind == "console":
            df.orderBy("seq").select(F.col("payload").cast("string")).write.format("console").option("truncate", False).save()
        elif self.kind == "http":
            http.send(http_request(df, self.dst), batch_id=batch_id, **self.options)
        else:
            df.sparkSession.dataSource.register(RawSource)
            kept = df.where("payload IS NOT NULL")
            if self.kind == "pattern":
                folder, rest = split_pattern(self.dst)
                in_order(kept, resolve_path(rest, F.col("topic"))).select("route", "payload").write.format("raw_bytes").mode("append").save(folder or ".")
            else:
                in_order(kept, F.lit("")).select("payload").write.format("raw_bytes").mode("append").save(self.dst)


def open_sink(dst: str, transactional: bool = False, **options) -> Sink:
    """The sink of a destination: - (console), http(s)://, a pattern with {topic}, or a path.

    Every {topic} of a pattern is replaced, and the folder that comes out holds the topic's
    files. Spark's storage schemes are paths. Another scheme is an error. Transactions go to
    files only, whose pattern needs {txnID}, as no other may have; they are published in the
    table that the option `table` names. With end_seq, only the newest commit of a path is.
    Options of http: those of http.send.
    """
    storage = ("hdfs://", "s3a://", "file://", "abfss://", "gs://", "viewfs://")
    remote = dst.startswith(("http://", "https://"))
    if transactional and (dst == "-" or remote):
        raise ValueError(f"transactions cannot be published to {dst!r}")
    if "://" in dst and not remote and not dst.startswith(storage):
        raise ValueError(f"unsupported scheme in {dst!r}")
    if transactional and "{txnID}" not in dst:
        raise ValueError(f"transactions would be published over one another: no {{txnID}} in {dst!r}")
    if not transactional and "{txnID}" in dst:
        raise ValueError(f"{{txnID}} in {dst!r} names nothing outside transactions")
    if transactional and "table" not in options:
        raise ValueError("transactions need the option table")
    kind = "console" if dst == "-" else "http" if remote else "pattern" if "{topic}" in dst or transactional else "path"
    return Sink(kind, dst, transactional, options)
