from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from larder.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of plain tuples."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is not None, str(x)) for x in t))

    return collect
