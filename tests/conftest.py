from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from caseload.session import local_session, release

    session = local_session("4", "caseload-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples; nulls first."""

    def collect(df, *columns):
        frame = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in frame.collect()), key=lambda t: [(x is not None, str(type(x)), x) for x in t])

    return collect
