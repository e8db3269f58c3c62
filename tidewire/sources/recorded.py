"""Recorded topics: batches of records with offsets by partition, read as a table or as a stream with the columns of Spark's Kafka source."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

RECORD = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int, headers array<struct<key:string,value:binary>>"
_COLUMNS = [x.split()[0] for x in RECORD.replace("array<struct<key:string,value:binary>>", "array").split(", ")]
#: Rows of a slice of a file that is read at once.
SLICE = 10_000


def record(records: DataFrame, path: str) -> None:
    """Append records (topic, partition, offset and what there is of RECORD) to the recorded topics in path.

    Files of a partition hold ranges of offsets in order, whose first and last are in their
    names, so that a reader finds what it needs from names alone. Offsets of a partition go up
    from one call to the next.
    """
    rows = records.select(*(F.col(c) if c in records.columns else F.lit(None).cast(t).alias(c) for c, t in (("key", "binary"), ("value", "binary"), ("topic", "string"), ("partition", "int"), ("offset", "long"), ("timestamp", "timestamp"), ("timestampType", "int"), ("headers", "array<struct<key:string,value:binary>>"))))

    def write(batches):
        store, top = _store(path)
        held: dict[tuple, list] = {}

        def flush(key):
            table = pa.Table.from_batches(held.pop(key))
            first, last = table["offset"][0].as_py(), table["offset"][-1].as_py()
            folder = f"{top}/{key[0]}/{key[1]}"
            store.create_dir(folder, recursive=True)
            pq.write_table(table, f"{folder}/{first:020d}-{last:020d}-{uuid.uuid4().hex}.parquet", filesystem=store)
            return pa.RecordBatch.from_pydict({"n": [table.num_rows]}, schema=pa.schema([("n", pa.int64())]))

        for batch in batches:
            keys = list(zip(batch["topic"].to_pylist(), batch["partition"].to_pylist(), strict=True))
            begin = 0
            for k in range(1, len(keys) + 1):
                if k == len(keys) or keys[k] != keys[begin]:
                    yield from [flush(x) for x in list(held) if x != keys[begin]]
                    held.setdefault(keys[begin], []).append(batch.slice(begin, k - begin))
                    begin = k
            yield from [flush(x) for x in list(held) if sum(b.num_rows for b in held[x]) >= 100_000]
        yield from [flush(x) for x in list(held)]

    rows.repartition("topic", "partition").sortWithinPartitions("topic", "partition", "offset").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _files(path: str) -> dict[str, list[tuple[int, int, str]]]:
    """(first, last, file) of the files of each `topic/partition`, in order of offset."""
    store, top = _store(path)
    found: dict[str, list] = {}
    for x in store.get_file_info(fs.FileSelector(top, recursive=True, allow_not_found=True)):
        *_, topic, partition, name = ["", "", *x.path.split("/")]
        if x.is_file and name.endswith(".parquet"):
            first, last, _ = name.split("-")
            found.setdefault(f"{topic}/{partition}", []).append((int(first), int(last), x.path))
    return {k: sorted(v) for k, v in sorted(found.items())}


class Slice(InputPartition):
    """The records of one topic and partition from offset `start` up to `end`, and the files that hold them."""

    def __init__(self, path: str, files: list[str], start: int, end: int):
        self.path, self.files, self.start, self.end = path, files, start, end


def _read(x: Slice) -> Iterator[pa.RecordBatch]:
    store, _ = _store(x.path)
    for file in x.files:
        with store.open_input_file(file) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=SLICE, columns=_COLUMNS, use_threads=False):
                inside = batch.filter(pc.and_(pc.greater_equal(batch["offset"], x.start), pc.less(batch["offset"], x.end)))
                if inside.num_rows:
                    yield inside


def _slices(path: str, start: dict[str, int], end: dict[str, int]) -> list[Slice]:
    out = []
    for key, files in _files(path).items():
        low, high = start.get(key, 0), end.get(key, 0)
        some = [f for a, b, f in files if b >= low and a < high]
        if some:
            out.append(Slice(path, some, low, high))
    return out


class RecordedTopic(DataSource):
    """spark.read or readStream.format("recorded_topic").load(path) of what `record` has written.

    The offsets of a micro-batch are the next one of each topic and partition, as the checkpoint
    has them: a query that is started again goes on from there. The path is any that driver and
    executors share and pyarrow opens.
    """

    @classmethod
    def name(cls) -> str:
        return "recorded_topic"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> DataSourceReader:
        return TableReader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return StreamReader(self.options["path"])


class TableReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Slice]:
        return _slices(self.path, {}, {k: v[-1][1] + 1 for k, v in _files(self.path).items()})

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class StreamReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return {k: v[-1][1] + 1 for k, v in _files(self.path).items()}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return _slices(self.path, start, end)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return _read(partition)

    def commit(self, end: dict) -> None:
        pass
