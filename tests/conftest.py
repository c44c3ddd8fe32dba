import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pagetrail.session import get_session

    s = get_session("local[4]", app_name="pagetrail-tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.default.parallelism": "4",
    })
    # tests run without a cluster checkpoint folder: set a private one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagetrail-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="pagetrail-test-")


SF_SMALL = "/root/testdata/sf0.001"
