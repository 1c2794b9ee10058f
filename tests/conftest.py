"""One Spark session for all tests; files go to fresh temporary folders."""

import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    tmp = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.local.dir", tmp + "/local").config("spark.sql.warehouse.dir", tmp + "/warehouse").config("spark.checkpoint.dir", "file://" + tmp + "/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
