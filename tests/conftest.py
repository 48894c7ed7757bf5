import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from forecheck.session import RECOMMENDED_CONF, ensure_checkpoint_dir

    builder = (SparkSession.builder.master("local[*]").appName("forecheck-tests")
               .config("spark.sql.shuffle.partitions", "8"))
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="forecheck-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def small_report(spark):
    from forecheck.plans.registry import report

    return report(spark, SF_SMALL)
