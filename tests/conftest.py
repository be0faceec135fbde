import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from lodestar.session import checkpoint_root, ship_package
    s = (SparkSession.builder.master("local[*]").appName("lodestar-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lodestar-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)
    ship_package(s)
    yield s
    s.stop()
