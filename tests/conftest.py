import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TESTDATA = Path(os.environ.get("TIDEWELL_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    """A new scratch folder; folders are left behind."""
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(scope="session")
def small():
    return str(TESTDATA / "sf0.001")
