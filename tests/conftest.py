from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

REPO = str(Path(__file__).resolve().parent.parent)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [REPO, os.environ.get("PYTHONPATH")]))
sys.path.insert(0, REPO)


@pytest.fixture(scope="session")
def spark():
    from docketlake.session import build_session

    session = build_session("tests", "local[4]", 4, spark__ui__showConsoleProgress="false", spark__driver__memory="3g", spark__sql__session__timeZone="UTC")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
