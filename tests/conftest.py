import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from govmill.inputs import Inputs  # noqa: E402
from govmill.session import configure  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[8]").appName("govmill-tests")
               .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "8g").config("spark.checkpoint.dir", f"{home}/shared")
               .config("spark.sql.warehouse.dir", f"{home}/warehouse").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    """One set of inputs for all tests, so stored tables are built once."""
    return Inputs(spark, SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
