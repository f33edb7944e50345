import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from shelfcurve.session import local_session

    session = local_session("8", "shelfcurve-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"


@pytest.fixture
def rows(spark):
    """Build a small frame: rows(schema, row, ...)."""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


@pytest.fixture
def values():
    """The rows of a frame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=str)
