"""Message and event-log tables derived from the driver's events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.operators.transactions import running_total
from tidewire.session import configure, materialise
from tidewire.sources.messages import normalize_messages

ALLOWED = ["click", "purchase", "view"]

RECORDS = """
SELECT event_id AS seq, CAST(floor(event_id / 10) AS BIGINT) AS request_id,
 CASE WHEN event_id % 29 = 0 THEN concat('../', event_type) ELSE event_type END AS topic,
 CAST(user_id % 4 AS INT) AS part,
 row_number() OVER (PARTITION BY CAST(floor(event_id / 10) AS BIGINT), event_type, user_id % 4, event_id % 29 = 0 ORDER BY event_id) - 1 AS off,
 CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '' ELSE concat('user-', CAST(user_id AS {S})) END AS k,
 CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '' ELSE props END AS v,
 CASE WHEN event_id % 17 = 0 THEN NULL ELSE {MS} END AS ts_ms,
 concat('10.0.0.', CAST(user_id % 16 AS {S}), ':', CAST(40000 + user_id % 100 AS {S})) AS client_addr,
 CASE WHEN event_id % 3 = 0 THEN concat('txn-', CAST(user_id % 20 AS {S})) END AS transactional_id
FROM {events}
"""

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message rows with seq, request_id, parse_error and handler_failed."""
    sql = RECORDS.replace("{S}", "STRING").replace("{MS}", "unix_millis(CAST(ts AS TIMESTAMP))")
    r = spark.sql(sql, events=_events(spark, sf_dir))
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    two = F.array(entry("src", F.lit("<a>&b")), entry("h", F.col("topic")))
    headers = F.when(F.col("seq") % 5 == 0, F.array().cast("array<struct<key:string,value:string>>")).when(F.col("seq") % 4 == 0, F.concat(two, F.array(entry("h", F.lit("dup"))))).otherwise(two)
    bad = r.where("seq % 97 = 0").select("request_id", "topic", "part").distinct().withColumn("parse_error", F.lit(True))
    r = r.join(bad, ["request_id", "topic", "part"], "left").withColumns({"headers": headers, "parse_error": F.coalesce("parse_error", F.lit(False)), "handler_failed": F.col("request_id") % 23 == 0, "timestamp": F.timestamp_millis("ts_ms")})
    r = r.withColumnsRenamed({"part": "partition", "off": "offset", "k": "key", "v": "value"})
    return normalize_messages(r.drop("ts_ms"))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as LOG has it, with the generator's own producer ids as assigned_pid for the streaming form; derived once, and written.

    Producer ids number the ids in order of their first INIT, within ranges of it and then over
    the ranges, so that no task sees all ids.
    """
    events = _events(spark, sf_dir)
    kind = F.when(F.col("event_type") == "signup", "INIT").when(F.col("event_type") == "view", "ADD").when(F.col("event_type") == "error", "END").otherwise("MSG")
    firsts = materialise(events.where("event_type = 'signup'").groupBy("user_id").agg(F.min("event_id").alias("first")).withColumn("part", F.floor(F.col("first") / F.lit(1 << 16))), "firsts")
    offsets = running_total(firsts.groupBy("part").agg(F.count("*").alias("n")), "part", "n").select("part", "before")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("first"))
    pids = firsts.withColumn("k", rank).join(offsets, "part").select("user_id", (F.col("before") + F.col("k")).cast("long").alias("assigned_pid"))
    seen = F.count_if(F.col("kind") == "INIT").over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = events.withColumn("kind", kind).withColumn("inits", seen).join(pids, "user_id", "left")
    asks = F.col("kind").isin("ADD", "END")
    return materialise(
        rows.select(
            F.col("event_id").alias("seq"),
            F.concat(F.lit("txn-"), F.col("user_id").cast("string")).alias("transactional_id"),
            "kind",
            F.col("event_type").alias("topic"),
            F.col("props").alias("value"),
            F.when(asks, F.when(F.col("inits") > 0, F.col("assigned_pid")).otherwise(F.lit(-1))).alias("claimed_pid"),
            F.when(asks, F.greatest("inits", F.lit(1)) - 1 - (F.col("event_id") % 5 == 0).cast("int")).cast("int").alias("claimed_epoch"),
            F.when(F.col("kind") == "END", F.col("event_id") % 3 != 0).alias("is_commit"),
            "assigned_pid",
        ),
        "log",
    )
