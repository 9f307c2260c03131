import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from verlog.session import local_session, work_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="verlog-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def tmp_table(spark):
    """A fresh table path under the shared work folder."""
    root = work_root(spark)
    return lambda name="t": f"{root}/verlog-tests/{name}-{uuid.uuid4().hex}"
