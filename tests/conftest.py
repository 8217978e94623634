import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from starloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 8, "8g")
    yield session
    session.stop()
