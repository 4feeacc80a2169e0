import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starload.session import local_session
    s = local_session("*", 8, app="starload-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_out(tmp_path):
    return str(tmp_path)
