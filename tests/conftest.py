import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from riskloom.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="riskloom-tests")
    yield s
    s.stop()
