"""Helpers shared by the corpus operators: shared tables, row groups in a stream, components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one of our own only where none is named and Spark runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        found = tempfile.mkdtemp(prefix="tidewire-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame, what: str, **options) -> DataFrame:
    """Write df as a table of the shared folder, with the writer's options, and read it again.

    This cuts the lineage: a lost executor costs the tasks it ran, never the steps before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidewire-{uuid.uuid4().hex}/{what}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trim() -> None:
    """Give memory that is free in this process back to the system: Arrow and malloc keep it, in each idle Python worker, beside later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


#: What this process keeps for its next tasks, and what the task at hand has asked for.
_kept: dict[object, object] = {}
_asked: set[object] = set()


def kept(key, make: Callable):
    """What `make` gives, made once for tasks that follow one another in this process; one thing at a time."""
    _asked.add(key)
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def trimmed(work: Callable) -> Callable:
    """A function for mapInArrow that trims when its task ends. What the task has not asked for is not kept beside it and later stages."""

    def run(batches):
        _asked.clear()
        try:
            yield from work(batches)
        finally:
            if not _asked:
                _kept.clear()
            trim()

    return run


#: Bytes of an Arrow batch that Spark sends to a Python worker, about (by rows alone, 10,000 texts
#: are one batch, whose buffers JVM and worker keep beside later stages), and rows that Spark's
#: Parquet reader holds at once in each task: of 4,096 texts the vectors alone are tens of MB of heap.
BATCH_BYTES, READ_ROWS = 4 << 20, 512
_LIMITS = {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES, "spark.sql.parquet.columnarReaderBatchSize": READ_ROWS}


def map_arrow(df: DataFrame, work: Callable, schema) -> DataFrame:
    """df.mapInArrow of work, trimmed, in batches bounded by BATCH_BYTES and READ_ROWS from here on in this session, unless it names its own limits."""
    conf = df.sparkSession.conf
    for name, limit in _LIMITS.items():
        if conf.get(name, None) is None:
            conf.set(name, str(limit))
    return df.mapInArrow(trimmed(work), schema)


def batches_of(size: int, rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most `size` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


#: Rows that become Python's at once.
SLICE_ROWS = 256


def runs(batches: Iterable[pa.RecordBatch], n_keys: int, unpack: Callable[[list], list] = lambda values: values) -> Iterator[tuple[tuple, list[tuple]]]:
    """Groups of consecutive rows that agree in the first `n_keys` columns of sorted batches.

    A run may span batches. Only the run at hand is held, beside SLICE_ROWS rows. unpack gets
    the values of the last column for as many rows at once.
    """
    key, held = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            *columns, last = (c.to_pylist() for c in batch.slice(at, SLICE_ROWS).columns)
            for row in zip(*columns, unpack(last), strict=True):
                if row[:n_keys] != key:
                    if held:
                        yield key, held
                    key, held = row[:n_keys], []
                held.append(row[n_keys:])
    if held:
        yield key, held


#: A key with more than one in HOT rows is hot; so fewer than HOT keys are.
HOT = 1000


def join_copies(rows: DataFrame, named: DataFrame) -> DataFrame:
    """rows, left-joined by key with named (key, copies, ...): a row for each key of rows, and how many of rows have it.

    The hot keys are broadcast, so their rows stay where they are, however many; the rows of
    other keys meet by shuffle. Rows without a key match nothing and do not move either.
    """
    named = materialise(named, "named")
    total = named.agg(F.sum("copies")).first()[0] or 0
    hot = F.broadcast(named.where(F.col("copies") * HOT > total).drop("copies"))
    others = named.where(F.col("copies") * HOT <= total).drop("copies")
    keyed = rows.where("key IS NOT NULL")
    cold = keyed.join(hot.select("key"), "key", "left_anti").join(others, "key", "left")
    return keyed.join(hot, "key").unionByName(cold).unionByName(rows.where("key IS NULL"), allowMissingColumns=True)


#: Nodes that a partition unites at once.
FOREST_NODES = 1 << 20


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one partition, FOREST_NODES nodes at a time: each beside the smallest it reaches."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > FOREST_NODES:
            yield from batches_of(50_000, ((x, root(x)) for x in list(parent) if root(x) != x), _EDGE)
            parent.clear()
    yield from batches_of(50_000, ((x, root(x)) for x in list(parent) if root(x) != x), _EDGE)


_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def connected_components(edges: DataFrame) -> DataFrame:
    """Distributed union-find: (node, component) for every node of `edges`, two long columns.

    The component is the smallest node reachable. Each partition first unites its own edges,
    which leaves a spanning forest. Then two star steps alternate until nothing changes: every
    node hands its larger neighbours, then its smaller ones, to the least of them. The number
    of rounds grows with the logarithm of the longest chain. Nothing is collected but a count
    and a checksum a round. Loops and null ends are ignored; an empty table gives an empty one.
    """
    a, b = edges.columns[:2]
    forest = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    forest = map_arrow(forest, _forest, "u long, v long")
    now = materialise(forest.distinct(), "forest")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        # Larger neighbours of u go to the smallest neighbour of u, or to u itself. Written
        # tables on both sides let AQE split the partition of a node with very many neighbours.
        least = materialise(now.groupBy("u").agg(F.min("v").alias("m")), "least")
        large = now.select(F.col("u").alias("child"), F.col("v").alias("u")).join(least, "u", "left")
        large = large.select(F.col("child").alias("u"), F.coalesce("m", "u").alias("v"))
        large = materialise(large.distinct(), "large")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
