import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tabprep.session import SQL_CONF, apply_conf
    builder = (SparkSession.builder.master("local[*]").appName("tabprep-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tabprep-wh-"))
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tabprep-ck-")))
    for k, v in SQL_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    apply_conf(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
