"""Sources: message rows from record tables, Kafka's connector or captured JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.operators.validate import validate_jsonl
from tidewire.session import materialise
from tidewire.sinks.published import publish

MESSAGE = "topic string, partition int, offset bigint, key binary, value binary, headers map<string,string>, timestamp timestamp, tombstone boolean, client_addr string, transactional_id string"
#: A captured JSON line.
LINE = "topic string, partition int, offset bigint, key string, key_encoding string, value string, value_encoding string, headers map<string,string>, timestamp string, client_addr string"


def collapse_headers(entries: Column | str) -> Column:
    """array<struct<key, value>> as a map in which the last value of a key wins; null counts as empty."""
    entries = F.coalesce(F.col(entries) if isinstance(entries, str) else entries, F.array().cast("array<struct<key:string,value:string>>"))
    names = F.transform(entries, lambda e: e["key"])
    last = F.filter(entries, lambda e, k: ~F.array_contains(F.slice(names, k + 2, F.greatest(F.size(names), F.lit(1))), e["key"]))
    return F.map_from_entries(last)


def normalize_messages(records: DataFrame) -> DataFrame:
    """Record rows as message rows; other columns, such as seq and request_id, stay behind them.

    records: topic, partition, offset, key, value, headers (array of key and value), timestamp,
    client_addr, transactional_id. A null value is a tombstone; an empty transactional id is none.
    """
    own = ["topic", "partition", "offset", "key", "value", "headers", "timestamp", "client_addr", "transactional_id"]
    return records.select(
        "topic",
        F.col("partition").cast("int"),
        F.col("offset").cast("long"),
        F.col("key").cast("binary"),
        F.col("value").cast("binary"),
        collapse_headers("headers").alias("headers"),
        "timestamp",
        F.col("value").isNull().alias("tombstone"),
        "client_addr",
        F.nullif(F.col("transactional_id"), F.lit("")).alias("transactional_id"),
        *(c for c in records.columns if c not in own and c != "tombstone"),
    )


def from_kafka(records: DataFrame) -> DataFrame:
    """Rows of Spark's Kafka source (read with includeHeaders) as message rows. It names no client or transaction."""
    entries = F.transform("headers", lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")))
    return normalize_messages(records.withColumns({"headers": entries, "client_addr": F.lit(""), "transactional_id": F.lit(None).cast("string")}).drop("timestampType"))


def event_log(messages: DataFrame, control: DataFrame) -> DataFrame:
    """Messages and transaction requests in one log with a `kind`: MSG, or INIT, ADD, END."""
    return messages.withColumn("kind", F.lit("MSG")).unionByName(control, allowMissingColumns=True)


def parse_jsonl(lines: DataFrame, column: str = "line") -> DataFrame:
    """Message rows from captured JSON lines; base64 keys and values are decoded, an absent key is null."""
    r = lines.select(F.from_json(column, LINE).alias("r"))

    def raw(field: str) -> Column:
        text = F.col(f"r.{field}")
        return F.when(F.col(f"r.{field}_encoding") == "base64", F.unbase64(text)).otherwise(text.cast("binary"))

    stamp = F.from_utc_timestamp(F.try_to_timestamp(F.regexp_replace("r.timestamp", r" \+0000 UTC$", "")), F.current_timezone())
    return r.select("r.topic", "r.partition", "r.offset", raw("key").alias("key"), raw("value").alias("value"), "r.headers", stamp.alias("timestamp"), "r.client_addr")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return parse_jsonl(spark.read.text(path).withColumnRenamed("value", "line"))


def stream_jsonl(spark: SparkSession, path: str, **options) -> DataFrame:
    """Captured lines of a folder as a stream (line), file by file as they come; options are those of Spark's text source."""
    return spark.readStream.options(**options).text(path).withColumnRenamed("value", "line")


def capture_jsonl(lines: DataFrame, table: str, quarantine: str, checkpoint: str) -> StreamingQuery:
    """Lines of a stream that conform, as message rows published in `table`; the others with their reasons in `quarantine`.

    A micro-batch is validated once and published in each by its number, so one that comes again takes its own place.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        checked = materialise(validate_jsonl(df), "checked")
        publish(parse_jsonl(checked.where(F.size("reasons") == 0)), table, batch_id)
        publish(checked.where(F.size("reasons") > 0).select("line", "reasons"), quarantine, batch_id)

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
