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

    from tessera.session import ENGINE_CONF, checkpoint_dir
    builder = (SparkSession.builder.master("local[*]").appName("tessera-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false"))
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(session, tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tessera-test-")
