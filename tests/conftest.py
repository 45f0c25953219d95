import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from daybook.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="daybook-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="daybook-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="daybook-test-")


@pytest.fixture(scope="session")
def events(spark):
    from daybook.sources.fixtures import load_events
    return load_events(spark, SF_SMALL)
