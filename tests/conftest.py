import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("pricetide-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows of text and numbers as a DataFrame; timestamps given as text are cast."""

    def make(rows, schema):
        df = spark.createDataFrame(rows, schema)
        if dict(df.dtypes).get("timestamp") == "string":
            df = df.withColumn("timestamp", df["timestamp"].cast("timestamp"))
        return df

    return make
