import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plateflow import configure_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("plateflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure_session(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
