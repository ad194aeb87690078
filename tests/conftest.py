import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    b = (SparkSession.builder.master("local[*]").appName("shopmetrics-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false"))
    s = b.getOrCreate()
    # tests only: give the session a checkpoint folder when the environment sets none
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        d = tempfile.mkdtemp(prefix="shopmetrics-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def workdir(spark):
    from shopmetrics.sources.tables import shared_dir
    return shared_dir(spark, "tests", unique=True)


def rows(df, *cols):
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
