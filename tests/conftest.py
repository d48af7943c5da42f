import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tarmac.session import LOCAL_DEFAULTS, SESSION_DEFAULTS

    builder = (SparkSession.builder.master("local[4]").appName("tarmac-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "4g"))
    for k, v in {**SESSION_DEFAULTS, **LOCAL_DEFAULTS}.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tarmac-test-")
