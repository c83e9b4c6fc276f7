import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillflow.session import engine_config  # noqa: E402


def make_session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '8')}]")
        .appName("tillflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", "/tmp/tillflow-warehouse")
    )
    for key, value in engine_config(shuffle_partitions=8).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
