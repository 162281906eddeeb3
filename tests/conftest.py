import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ws(spark):
    """The shared workspace over the smallest data set."""
    from compare import SMALL
    from starmill.plans.workspace import workspace

    return workspace(spark, SMALL)


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(name, value):
        before.setdefault(name, spark.conf.get(name))
        spark.conf.set(name, value)

    yield set_option
    for name, value in before.items():
        spark.conf.set(name, value)
