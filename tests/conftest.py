import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starlane.session import build_session

    s = build_session("local[4]", "starlane-tests", shuffle_partitions=4)
    # Tests run without a cluster: the checkpoint folder is unset, so set one.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starlane-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="starlane-test-")
