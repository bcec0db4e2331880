import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from traitloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("tests", 8, "6g", spark__checkpoint__dir=shared)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, missing values first."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t])

    return collect
