"""Published tables: batches of files by path, each of which appears whole, and in which a later commit of a path replaces an earlier one.

data/name=<batch> has the rows of a batch, paths/name=<batch> its distinct paths, and manifest one
small file for each publication. A batch counts once its line is in the manifest. Lines have a
version, one more than any before: of several lines of one batch the greatest version counts.
Of several batches with a path the greatest batch_id has it, whenever they were published, so a
replay of an old batch does not bring back what a later one replaced. compact writes what is
visible as one new base; vacuum then deletes what no reader needs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

LINE = "version long, batch_id long, name string, base boolean"


def _lines(spark: SparkSession, table: str) -> DataFrame:
    """All lines of the manifest; none where nothing was published."""
    try:
        return spark.read.schema(LINE).parquet(f"{table}/manifest")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LINE)


def _enter(spark: SparkSession, table: str, batch_id: int, name: str, base: bool) -> None:
    """The one step that publishes."""
    last = _lines(spark, table).agg(F.max("version")).first()[0]
    line = spark.createDataFrame([((last or 0) + 1, batch_id, name, base)], LINE)
    line.coalesce(1).write.mode("append").parquet(f"{table}/manifest")


def _stage(df: DataFrame, table: str, batch_id: int) -> str:
    """Write a batch where no reader looks yet: its name."""
    spark, name = df.sparkSession, f"b{batch_id}-{uuid.uuid4().hex}"
    df.write.parquet(f"{table}/data/name={name}")
    if "path" in df.columns:
        written = spark.read.schema(df.schema).parquet(f"{table}/data/name={name}")
        written.select(F.lit(batch_id).cast("long").alias("batch_id"), "path").distinct().write.parquet(f"{table}/paths/name={name}")
    return name


def publish(df: DataFrame, table: str, batch_id: int) -> None:
    """Publish df as a batch of the table, whole or not at all.

    With a column path, each of its paths replaces that path of all smaller batch_ids; an empty
    batch changes nothing. Without one, rows stand beside those of other batches. A replay of the batch is
    published in its place, or left out if the batch is part of a base by then.
    """
    _enter(df.sparkSession, table, batch_id, _stage(df, table, batch_id), False)


def live(spark: SparkSession, table: str) -> DataFrame:
    """(batch_id, name, base): what readers see: the newest base, and the newest line of each batch behind it."""
    lines = _lines(spark, table)
    base = lines.where("base").agg(F.max(F.struct("batch_id", "version")).alias("b"))
    behind = lines.where("NOT base").join(base, F.col("b").isNull() | (F.col("batch_id") > F.col("b.batch_id"))).groupBy("batch_id").agg(F.max_by("name", "version").alias("name"))
    own = lines.where("base").join(base, F.col("version") == F.col("b.version")).select("batch_id", "name")
    return behind.withColumn("base", F.lit(False)).unionByName(own.withColumn("base", F.lit(True)))


def _names(spark: SparkSession, table: str) -> list[str]:
    """Names of what is live: a line for each batch since the newest base."""
    return [r["name"] for r in live(spark, table).select("name").collect()]


def read_published(spark: SparkSession, table: str) -> DataFrame:
    """The rows that the table shows: of all live batches, those of paths that no later batch has.

    Batches are partitions of one directory, of which the plan reads the live ones. What later
    batches replaced is found from the lists of paths, and taken out by an anti-join with it
    alone: rows that stay are not shuffled where few paths were replaced.
    """
    names = _names(spark, table)
    if not names:
        raise ValueError(f"nothing is published in {table}")
    schema = spark.read.parquet(f"{table}/data/name={names[-1]}").schema
    data = spark.read.schema(schema.add("name", "string")).parquet(f"{table}/data").where(F.col("name").isin(names))
    if "path" not in data.columns:
        return data.drop("name")
    paths = spark.read.parquet(f"{table}/paths").where(F.col("name").isin(names))
    newest = paths.groupBy("path").agg(F.max("batch_id").alias("newest"))
    gone = paths.join(newest, "path").where("batch_id < newest").select("name", "path")
    return data.join(gone, ["name", "path"], "left_anti").drop("name")


def compact(spark: SparkSession, table: str) -> None:
    """Write what the table shows as one base, which stands for all batches up to the greatest that is live."""
    last = live(spark, table).agg(F.max("batch_id")).first()[0]
    if last is not None:
        _enter(spark, table, last, _stage(read_published(spark, table), table, last), True)


def vacuum(spark: SparkSession, table: str) -> None:
    """Delete batches that are not live: replaced, unpublished, or part of the base. Nobody may be publishing or reading an older state meanwhile."""
    keep = {f"name={n}" for n in _names(spark, table)}
    for part in ("data", "paths"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{part}")
        store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if store.exists(folder):
            for found in store.listStatus(folder):
                if found.getPath().getName().startswith("name=") and found.getPath().getName() not in keep:
                    store.delete(found.getPath(), True)
