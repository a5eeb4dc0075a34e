import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression over one row of literals."""

    def run(column, row=None, schema="x int"):
        df = spark.createDataFrame([row or (1,)], schema)
        return df.select(column.alias("v")).collect()[0]["v"]

    return run


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
