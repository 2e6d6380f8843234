import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tools.local_session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path)
