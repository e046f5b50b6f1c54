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
    from framewright.session import local_session
    chk = tempfile.mkdtemp(prefix="fw-test-chk-")
    s = local_session(cores=8, shuffle_partitions=8, extra={"spark.checkpoint.dir": chk})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck01():
    from tests.oracle import duck
    return duck(SF01)
