import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siftwork.session import local_session  # noqa: E402

DATA = os.environ.get("SIFTWORK_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, "4g")
    s.sparkContext.setLogLevel("OFF")
    yield s


@pytest.fixture(scope="session")
def small():
    path = f"{DATA}/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path


@pytest.fixture(scope="session")
def tiny():
    path = f"{DATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path
