import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("pricestream-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # The checkpoint folder comes from spark.checkpoint.dir when the deployment sets
    # it; otherwise pricestream.session.checkpoint_dir makes a scratch one.
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="pricestream-test-")
