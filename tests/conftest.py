import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")  # for the Python workers
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rasterloom.session import local_session

    s = local_session("tests", 4, partitions=4, memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
