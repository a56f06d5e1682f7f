import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ringfence.session import get_session
    ckpt = tempfile.mkdtemp(prefix="ringfence-test-ckpt-")
    s = get_session(app="ringfence-tests", master="local[4]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="ringfence-test-")
