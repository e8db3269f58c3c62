"""Streaming: the capture pipeline, and transactions resolved in keyed state and published."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from operator import itemgetter

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewire.functions.render import render
from tidewire.operators.messages import filter_topics
from tidewire.operators.transactions import EPOCHS
from tidewire.session import materialise
from tidewire.sinks.files import open_sink

RESOLVED = "seq long, transactional_id string, topic string, value binary, end_seq long"
#: Rows of a run of pending rows in state, and rows of an id that a micro-batch holds before they go there.
CHUNK, BUFFER = 4096, 65536
_seq = itemgetter(0)


def run_pipeline(stream: DataFrame, topics: list[str], fmt: str, write: Callable[[DataFrame, int], None], checkpoint: str, **options) -> StreamingQuery:
    """Filter, render and write every micro-batch; a batch is acknowledged when `write` returns.

    An error in it fails the query before the checkpoint moves on, so the batch comes again
    under the same number.
    """
    rendered = render(filter_topics(stream, topics), fmt, **options)
    return rendered.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class TransactionResolver(StatefulProcessor):
    """Holds the rows of each open transaction; a commit releases them in order of seq, an abort drops them.

    INIT rows carry assigned_pid. Input is in order of seq from one micro-batch to the next; in
    a micro-batch it may be in any. Messages wait in memory to the end of the
    micro-batch, BUFFER of an id at most; more, and what outlasts it, go to state in sorted runs
    of CHUNK rows. A release opens only runs that overlap, one for each BUFFER of rows about.

    ttl_ms: a transaction that gets no row for so long is dropped as a whole at the end of the
    next micro-batch, and so is what still comes of it up to the next terminal of its id; a
    commit then releases nothing. By default it waits until it ends, as in a batch.
    """

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.producer = handle.getValueState("producer", "inits long, pid long, active boolean, dropped boolean, timer long")
        self.pending = handle.getMapState("pending", "chunk long, run long", "rows array<struct<seq:long,topic:string,value:binary>>")

    def _append(self, rows: list[tuple]) -> list[tuple]:
        """Put rows into runs in order of seq, of CHUNK rows each, told by their first and last seq: the runs' keys."""
        rows.sort(key=_seq)
        runs = [rows[k : k + CHUNK] for k in range(0, len(rows), CHUNK)]
        keys = [(run[0][0], run[-1][0]) for run in runs]
        for key, run in zip(keys, runs, strict=True):
            self.pending.updateValue(key, (run,))
        return keys

    def _release(self, key, end: int, commit: bool, held: list[tuple], stored: list[tuple]) -> Iterator[Row]:
        """What waits before `end`, in order of seq; it leaves `held`, the rows at hand, and the runs `stored` in state.

        Runs are opened in order of their first row, so that only those that overlap are at hand at once.
        """
        ready = sorted((r for r in held if r[0] < end), key=_seq)
        held[:] = [r for r in held if r[0] >= end]
        first = sorted(k for k in stored if k[0] < end)
        stored[:] = [k for k in stored if k[0] >= end]
        for run in [*first, (end, end)]:
            n = bisect_left(ready, run[0], key=_seq)
            for seq, topic, value in ready[:n] if commit else ():
                yield Row(seq=seq, transactional_id=key[0], topic=topic, value=value, end_seq=end)
            ready = ready[n:]
            if run[0] < end:
                # State takes plain tuples only.
                rows = [tuple(r) for r in self.pending.getValue(run)[0]]
                self.pending.removeKey(run)
                if later := [r for r in rows if r[0] >= end]:
                    stored += self._append(later)
                ready = sorted(ready + [r for r in rows if r[0] < end], key=_seq)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.producer.get()
        inits, pid, active, dropped, timer = known or (0, None, False, False, None)
        stored = [tuple(k) for k in self.pending.keys()] if known else []
        requests, held = [], []
        for r in rows:
            if r["kind"] == "MSG":
                held.append((r["seq"], r["topic"], r["value"]))
                if len(held) >= BUFFER:
                    stored += self._append(held)
                    held = []
            else:
                requests.append(r)
        for r in sorted(requests, key=lambda r: r["seq"]):
            valid = inits > 0 and r["claimed_pid"] == pid and r["claimed_epoch"] == (inits - 1) % EPOCHS
            ends = valid and r["kind"] == "END" or r["kind"] == "INIT" and (active or dropped)
            if ends:
                yield from self._release(key, r["seq"], r["kind"] == "END" and r["is_commit"] and not dropped, held, stored)
                dropped = False
            if r["kind"] == "INIT":
                inits, pid, active = inits + 1, r["assigned_pid"], False
            elif valid:
                active = r["kind"] == "ADD"
        waits = bool(held or stored)
        if dropped and stored:
            self.pending.clear()
        if held and not dropped:
            self._append(held)
        if self.ttl_ms is not None:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = None
            if (waits or active) and not dropped:
                timer = timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms
                self.handle.registerTimer(timer)
        self.producer.update((inits, pid, active, dropped, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        inits, pid, _, _, _ = self.producer.get()
        self.pending.clear()
        self.producer.update((inits, pid, False, True, None))
        return iter(())

    def close(self) -> None:
        pass


def resolve_transactions_stream(log: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Committed messages of a streaming log; needs the RocksDB state store. Without ttl_ms it equals committed_messages of the whole log."""
    known = log.where("transactional_id IS NOT NULL").withColumn("value", F.col("value").cast("binary"))
    return known.groupBy("transactional_id").transformWithState(TransactionResolver(ttl_ms), RESOLVED, "append", "none" if ttl_ms is None else "processingTime")


def run_transactions(log: DataFrame, pattern: str, table: str, checkpoint: str, fmt: Callable[[DataFrame], DataFrame], ttl_ms: int | None = None) -> StreamingQuery:
    """Resolve a streaming log and publish what each micro-batch commits, by path, in a table for read_published.

    Exactly once: state and micro-batch are those of the checkpoint, a micro-batch is published
    by one line of the manifest, and one that comes again takes its own place. fmt adds `payload`.
    The query ends when all there is has been read; with ttl_ms, whose timers need it, it goes on until it is stopped.
    """
    sink = open_sink(pattern, transactional=True, table=table)
    resolved = resolve_transactions_stream(log, ttl_ms)

    def publish(df: DataFrame, batch_id: int) -> None:
        # The sink reads its rows twice, for the newest commits and for what they hold; state is gone through once.
        sink.write(fmt(materialise(df, "resolved")), batch_id)

    return resolved.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(**({"availableNow": True} if ttl_ms is None else {"processingTime": "1 second"})).start()
