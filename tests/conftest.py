import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from rivulet.session import BASE_CONF

    b = SparkSession.builder.master("local[*]").appName("rivulet-tests")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rivulet-test-ckpt-"))
    yield s
    s.stop()
