import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[*]").appName("odspark-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="odspark-test-ckpt-", dir="/tmp"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from odspark.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    yield spark


def ways_df(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "way_id long, tags map<string,string>")
