import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from duotower.session import get_session

    s = get_session("local[4]", app="duotower-tests", shuffle_partitions=4)
    yield s
    s.stop()
