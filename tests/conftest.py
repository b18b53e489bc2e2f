import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="strata-test-", dir="/tmp")
