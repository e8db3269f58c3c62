"""Session settings that the operators rely on, in one place."""

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Render times in UTC. Nothing else is needed: header maps are built without duplicate keys."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the folder that the cluster shares; a local one only where none is named and Spark runs in one process."""
    import tempfile
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        shared = tempfile.mkdtemp(prefix="tidewire-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/tidewire-{uuid.uuid4().hex}/{what}"


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write df to the shared folder and read it again: what follows uses it often, and no executor's loss undoes it."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
