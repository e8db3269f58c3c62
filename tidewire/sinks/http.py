"""HTTP delivery with retries over kept connections, an outbox that remembers what was answered, and dead letters."""

from __future__ import annotations

import contextlib
import json
import select
import time
import uuid
from collections.abc import Callable
from http.client import HTTPConnection, HTTPException, HTTPSConnection
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidewire.session import materialise, scratch

OUTCOME = "seq long, attempts int, status int, delivered boolean, last_error string, payload binary"
#: (url, body, headers) -> status
Transport = Callable[[str, bytes, dict], int]


class Session:
    """Posts over one connection to each host, which stays open as long as the host lets it.

    Header values go as UTF-8 bytes. A connection that its host has closed meanwhile is opened again before a post.
    """

    def __init__(self, timeout: float = 30.0):
        self.timeout, self.open = timeout, {}

    def __call__(self, url: str, body: bytes, headers: dict) -> int:
        parts = urlsplit(url)
        key = parts.scheme, parts.netloc
        kept = self.open.get(key)
        if kept is None:
            kind = HTTPSConnection if parts.scheme == "https" else HTTPConnection
            kept = self.open[key] = kind(parts.netloc, timeout=self.timeout)
        elif kept.sock is not None and select.select([kept.sock], [], [], 0)[0]:  # nothing is due: the host has closed it
            kept.close()
        try:
            raw = {k: v.encode() for k, v in headers.items()}
            kept.request("POST", (parts.path or "/") + (f"?{parts.query}" if parts.query else ""), bytes(body), raw)
            reply = kept.getresponse()
            reply.read()
            return reply.status
        except BaseException:
            self.open.pop(key).close()  # what is left of a broken exchange is no part of the next
            raise

    def close(self) -> None:
        for kept in self.open.values():
            kept.close()


ANSWER = "seq long, attempts int, status int, delivered boolean, last_error string"


class Outbox:
    """What has been answered, a JSON line for each row: a task that is tried again does not post it again.

    A line is written when a row is done with, before the next one is posted. Where the folder's
    store shows a file only once it is closed, a task that is killed, rather than fails, may
    post again what it had answered.
    """

    def __init__(self, folder: str):
        from pyarrow import fs

        self.store, top = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        self.folder, self.known, self.out = f"{top}/{TaskContext.get().partitionId():06d}", {}, None
        for found in self.store.get_file_info(fs.FileSelector(self.folder, allow_not_found=True)):
            with self.store.open_input_stream(found.path) as f:
                for line in f.read().splitlines():
                    with contextlib.suppress(ValueError):  # one that broke off with its task
                        answer = json.loads(line)
                        self.known[answer["seq"]] = [answer[c] for c in ("attempts", "status", "delivered", "last_error")]

    def add(self, seq: int, answer: list) -> None:
        if self.out is None:
            self.store.create_dir(self.folder, recursive=True)
            self.out = self.store.open_output_stream(f"{self.folder}/{uuid.uuid4().hex}")
        line = dict(zip(("seq", "attempts", "status", "delivered", "last_error"), (seq, *answer), strict=True))
        self.out.write((json.dumps(line) + "\n").encode())
        self.out.flush()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def deliver(requests: DataFrame, transport: Callable[[], Transport] = Session, retries: int = 0, delay: float = 1.0, outbox: str | None = None) -> DataFrame:
    """(seq, attempts, status, delivered, last_error, payload) for requests (seq, url, body, http_headers).

    A partition posts its rows one by one in order of seq through a transport of its own; status
    200 alone is success, and a row is tried 1 + retries times. Whatever goes wrong with a row,
    a header that HTTP does not allow too, is its outcome. Posts are side effects: write the
    outcome before splitting it, or Spark may post again. outbox: a folder for this delivery
    alone (see Outbox); requests are then to be a written table, so that a task tried again has the same rows.
    """

    def attempt(post: Transport, url, body, headers) -> list:
        status, error, n = None, None, 0
        for n in range(1, 2 + max(0, retries)):
            if n > 1 and delay:
                time.sleep(delay)
            try:
                status = post(url, body, dict(headers))
                error = None if status == 200 else f"status {status}"
            except (OSError, HTTPException, ValueError) as e:
                status, error = None, f"{type(e).__name__}: {e}"
            if error is None:
                break
        return [n, status, error is None, error]

    def run(batches):
        post, box = transport(), Outbox(outbox) if outbox else None
        try:
            for batch in batches:
                rows = []
                for seq, url, body, headers in batch.itertuples(index=False):
                    seq = int(seq)  # noqa: PLW2901
                    answer = box.known.get(seq) if box else None
                    if answer is None:
                        answer = attempt(post, url, body, headers)
                        if box:
                            box.add(seq, answer)
                    rows.append((seq, *answer, body))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUTCOME.split(", ")]).astype({"status": "Int32"})
        finally:
            if box:
                box.close()
            if hasattr(post, "close"):
                post.close()

    return requests.select("seq", "url", "body", "http_headers").sortWithinPartitions("seq").mapInPandas(run, OUTCOME)


def send(requests: DataFrame, dead_letters: str | None = None, transport: Callable[[], Transport] = Session, retries: int = 0, delay: float = 1.0, ledger: str | None = None, batch_id: int = 0) -> None:
    """Deliver requests once, and append what was not delivered to the table dead_letters; without one it is an error.

    ledger: a folder where the answers to each batch_id stay. A batch that comes again, after a
    failure or from a checkpoint, posts only rows that no earlier try of it delivered.
    """
    spark = requests.sparkSession
    path = f"{ledger}/batch_id={batch_id}" if ledger else scratch(spark, "outbox")
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    if found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found):
        earlier = spark.read.option("recursiveFileLookup", "true").option("mode", "DROPMALFORMED").schema(ANSWER).json(path)
        requests = requests.join(earlier.where("delivered").select("seq"), "seq", "left_anti")
    requests = materialise(requests.select("seq", "url", "body", "http_headers"), "requests")
    outcomes = materialise(deliver(requests, transport, retries, delay, f"{path}/try={uuid.uuid4().hex}"), "outcomes")
    if dead_letters is None:
        require_delivered(outcomes)
    else:
        split_delivered(outcomes)[1].write.mode("append").parquet(dead_letters)


def split_delivered(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(delivered, dead letters) of a written outcome table."""
    return outcomes.where("delivered"), outcomes.where("NOT delivered")


def require_delivered(outcomes: DataFrame) -> None:
    """Without a dead-letter table, a row that was not delivered is an error."""
    lost = outcomes.where("NOT delivered").limit(1).collect()
    if lost:
        raise RuntimeError(f"row {lost[0]['seq']} was not delivered after {lost[0]['attempts']} attempts: {lost[0]['last_error']}")
