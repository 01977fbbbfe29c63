from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martloom.session import local_session

    session = local_session(8, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SMALL
