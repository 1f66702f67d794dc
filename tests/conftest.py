import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from outlay.session import get_session
    s = get_session("local[4]", 8)
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="outlay-test-")
