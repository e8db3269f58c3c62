"""Filters, outcomes and aggregates over message rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.operators.transactions import RANGE

#: Outcome codes of a partition of a request: these must be these numbers.
OK, FAILED, CORRUPT, UNKNOWN_TOPIC = 0, -1, 2, 3
#: Topics up to which the allow-list is part of the plan; a longer one is joined.
IN_LIST = 1000


def _allowed(df: DataFrame, topics: list[str], how: str) -> DataFrame:
    names = df.sparkSession.createDataFrame([(t,) for t in sorted(set(topics))], "topic string")
    return df.join(names, "topic", how)


def filter_topics(df: DataFrame, topics: list[str]) -> DataFrame:
    """Rows of the allowed topics; an empty list allows all."""
    if not topics:
        return df
    return df.where(F.col("topic").isin(topics)) if len(topics) <= IN_LIST else _allowed(df, topics, "left_semi")


def rejected_topics(df: DataFrame, topics: list[str]) -> DataFrame:
    """The other rows, with their error code."""
    if not topics:
        return df.limit(0).withColumn("error_code", F.lit(UNKNOWN_TOPIC))
    other = df.where(~F.coalesce(F.col("topic").isin(topics), F.lit(False))) if len(topics) <= IN_LIST else _allowed(df, topics, "left_anti")
    return other.withColumn("error_code", F.lit(UNKNOWN_TOPIC))


def split_tombstones(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a value, tombstones)."""
    return df.where("value IS NOT NULL"), df.where("value IS NULL")


def require_transactional(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of a transaction, rows that lack one)."""
    inside = F.coalesce(F.col("transactional_id"), F.lit("")) != ""
    return df.where(inside), df.where(~inside)


def produce_outcomes(df: DataFrame, topics: list[str]) -> DataFrame:
    """(request_id, topic, partition, code, n): one outcome for each partition of a request.

    df: also parse_error and handler_failed. An unknown topic comes before a corrupt partition,
    and either before the handler's failure, which hits the request's clean partitions.
    """
    unknown = ~F.col("topic").isin(topics) if topics else F.lit(False)
    rank = F.when(unknown, F.struct(F.lit(3).alias("rank"), F.lit(UNKNOWN_TOPIC).alias("code")))
    rank = rank.when(F.col("parse_error"), F.struct(F.lit(2).alias("rank"), F.lit(CORRUPT).alias("code")))
    rank = rank.when(F.col("handler_failed"), F.struct(F.lit(1).alias("rank"), F.lit(FAILED).alias("code")))
    rank = rank.otherwise(F.struct(F.lit(0).alias("rank"), F.lit(OK).alias("code")))
    grouped = df.groupBy("request_id", "topic", "partition").agg(F.max(rank).alias("r"), F.count("*").alias("n"))
    return grouped.select("request_id", "topic", "partition", F.col("r.code").alias("code"), "n")


def request_batches(df: DataFrame, topics: list[str]) -> DataFrame:
    """(request_id, n, bytes, n_topics) of the accepted rows of each request."""
    kept = filter_topics(df, topics).where("NOT parse_error")
    return kept.groupBy("request_id").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).cast("long").alias("bytes"), F.countDistinct("topic").alias("n_topics"))


def assemble_files(df: DataFrame, chunk_bytes: int = 1 << 20) -> DataFrame:
    """(path, chunk, start, content): the payloads of each path in order of seq, in chunks.

    start: the bytes of the path before the chunk. A payload belongs to the chunk that its own
    first byte falls in, start div chunk_bytes; null and empty ones add nothing. Where a payload
    starts is found from sums over ranges of seq, so neither a path nor its rows meet in one
    task: a window has one range of it, and a row one chunk. df is read twice, once without content.
    """
    part = F.floor(F.col("seq") / F.lit(RANGE))
    rows = df.select("path", "seq", F.coalesce("payload", F.lit(b"")).alias("payload")).withColumns({"part": part, "size": F.octet_length("payload").cast("long")})
    sums = rows.groupBy("path", "part").agg(F.sum("size").alias("n"))
    sums = sums.select("path", "part", (F.sum("n").over(Window.partitionBy("path").orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("size").over(Window.partitionBy("path", "part").orderBy("seq")) - F.col("size")
    placed = rows.withColumn("within", within).join(sums, ["path", "part"]).withColumn("start", F.col("before") + F.col("within"))
    placed = placed.withColumn("chunk", F.floor(F.col("start") / F.lit(chunk_bytes)))
    # Each byte as a character and back, since bytes cannot be joined.
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "payload"))), lambda p: F.decode(p["payload"], "ISO-8859-1")), "")
    return placed.groupBy("path", "chunk").agg(F.min("start").alias("start"), F.encode(text, "ISO-8859-1").alias("content"))


def path_collisions(df: DataFrame) -> DataFrame:
    """(path, names) of sanitised names (raw, path) that more than one raw name reaches."""
    return df.select("path", "raw").distinct().groupBy("path").agg(F.array_sort(F.collect_list("raw")).alias("names")).where(F.size("names") > 1)
