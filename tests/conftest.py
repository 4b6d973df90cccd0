import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import get_session

    s = get_session("4", "corpusmill-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from tests.oracle_harness import duck as make

    return make(SMALL)
