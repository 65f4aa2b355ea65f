import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loanlens.session import get_session
    s = get_session("local[*]", 8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
