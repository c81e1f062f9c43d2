import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from aerostar.session import get_spark
    s = get_spark("local[4]", app="aerostar-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aerostar-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="aerostar-test-")
