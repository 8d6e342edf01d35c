from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from candlemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "candlemill-tests",
        spark__master="local[8]",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__checkpoint__dir=str(base / "checkpoints"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
