import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("gapweave-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


READINGS = T.StructType(
    [
        T.StructField("wban", T.StringType()),
        T.StructField("datetime", T.TimestampNTZType()),
        T.StructField("temperature", T.DoubleType()),
    ]
)


@pytest.fixture
def readings(spark):
    """Build a readings DataFrame from (wban, datetime or ISO text, value) rows."""

    def build(rows, partitions=3):
        rows = [
            (w, datetime.fromisoformat(t) if isinstance(t, str) else t, None if v is None else float(v))
            for w, t, v in rows
        ]
        return spark.createDataFrame(rows, READINGS).repartition(partitions)

    return build
