"""One small local session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import build_session, ship_package  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(4, "4g", "tests", **{"spark__sql__shuffle__partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """Collects a frame as a sorted list of tuples."""
    return lambda frame: sorted((tuple(r) for r in frame.collect()), key=repr)
