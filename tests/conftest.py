import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from skyledger.session import build_session
    s = build_session("local[4]", app="skyledger-tests", shuffle_partitions=8)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="skyledger-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="skyledger-test-")
