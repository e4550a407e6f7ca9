import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidyleads.session import checkpoint_dir, local_session
    s = local_session(cores=4, shuffle_partitions=4, app="tidyleads-tests")
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SMALL
