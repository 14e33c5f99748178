import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from valuescope.session import build_session, ensure_checkpoint_dir
    s = build_session("local[4]", app="valuescope-tests", shuffle_partitions=8)
    ensure_checkpoint_dir(s)
    yield s
    from valuescope.session import release_scratch
    release_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="vs-test-")


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
