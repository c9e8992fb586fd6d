import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("driver tables not present")
    return SF_SMALL
