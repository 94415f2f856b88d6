import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pitlake.session import get_session
    s = get_session("local[4]", 4, app="pitlake-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path(tmp_path):
    return str(tmp_path)

