import os
import sys
from datetime import timedelta

import pytest
from pyspark.sql import SparkSession

TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(TESTS), TESTS]

from times import START  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Builds a DataFrame from dicts whose `ts` is in seconds after the start."""

    def build(rows, schema):
        names = [part.split()[0] for part in schema.split(",")]
        data = [
            tuple(
                START + timedelta(microseconds=round(row[n] * 1_000_000)) if n == "ts" else row[n] for n in names
            )
            for row in rows
        ]
        return spark.createDataFrame(data, schema)

    return build
