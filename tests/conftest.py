import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from stagewise.session import get_spark
    # tests are the one place where this package sets its own checkpoint dir
    b = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
    b = b.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="stagewise-test-wh-"))
    b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stagewise-test-ckpt-")).getOrCreate()
    s = get_spark("local[4]", shuffle_partitions=4)
    yield s
    s.stop()
