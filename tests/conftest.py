import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import TINY  # noqa: E402
from edgetide.storage import drop_all  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("edgetide-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.codegen.useIdInClassName", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_all(session)
    session.stop()


@pytest.fixture(scope="session")
def make_edges(spark):
    def make(pairs):
        return spark.createDataFrame([(a, b) for a, b in pairs], "src string, dst string")

    return make


@pytest.fixture(scope="session")
def tiny(make_edges):
    return make_edges(TINY)


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"
