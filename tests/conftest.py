from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from docketry.session import with_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[*]").appName("docketry-tests")
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
    builder = builder.config("spark.driver.memory", "6g").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session = with_settings(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Apply a column function to texts; gives the list of results."""

    def run(function, values):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), "n int, x string")
        return [r[0] for r in df.orderBy("n").select(function(F.col("x"))).collect()]

    return run
