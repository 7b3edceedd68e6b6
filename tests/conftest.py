from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from touchline.session import HOT_ROWS_KEY  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["plain", "hot"])
def sizes(request, spark):
    """Run a test with ordinary windows and again with every larger key split."""
    spark.conf.set(HOT_ROWS_KEY, "1000000" if request.param == "plain" else "25")
    yield request.param
    spark.conf.unset(HOT_ROWS_KEY)


@pytest.fixture
def hot(spark):
    spark.conf.set(HOT_ROWS_KEY, "25")
    yield
    spark.conf.unset(HOT_ROWS_KEY)
