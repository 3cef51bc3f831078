import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tally.session import build_session

    s = build_session("local[4]", 8, app="tally-tests")
    yield s


SF = "/root/testdata/sf0.001"
