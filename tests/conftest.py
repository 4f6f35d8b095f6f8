import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    tmp = tempfile.mkdtemp(prefix="spark-")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.local.dir", tmp)
        .config("spark.checkpoint.dir", tmp + "/checkpoints").config("spark.sql.warehouse.dir", tmp + "/warehouse").getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
