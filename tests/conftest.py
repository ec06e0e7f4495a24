import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8, app="ledgerlens-tests")
    yield s
    s.stop()
