import os
import sys
from pathlib import Path

import pytest

TOP = str(Path(__file__).parent.parent)
sys.path.insert(0, TOP)
os.environ["PYTHONPATH"] = os.pathsep.join([TOP, os.environ.get("PYTHONPATH", "")])  # for Spark's Python workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    top = tmp_path_factory.mktemp("spark")
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": f"{top}/shared", "spark.driver.memory": "4g"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
