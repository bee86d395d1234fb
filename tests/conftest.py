import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from ledgerlake.session import tune
    s = (SparkSession.builder.master("local[4]").appName("ledgerlake-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    tune(s)
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        # tests only: the cluster names a shared folder in spark.checkpoint.dir
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlake-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerlake-test-")


SF = "/root/testdata/sf0.001"
