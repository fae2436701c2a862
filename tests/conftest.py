import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

TESTS = Path(__file__).resolve().parent
for folder in (TESTS, TESTS.parent):
    sys.path.insert(0, str(folder))
# Python tasks import what the tests hand them.
os.environ["PYTHONPATH"] = os.pathsep.join([str(TESTS), str(TESTS.parent), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
