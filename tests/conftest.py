import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from starloom.session import build_session

    s = build_session("local[4]", "starloom-tests", shuffle_partitions=8,
                      conf={"spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sl-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="sl-test-")
