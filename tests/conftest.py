import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from edgeweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = local_session(8, "edgeweave-tests", **{"spark.checkpoint.dir": shared, "spark.local.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def edges(spark):
    """Build an edge frame from Python pairs."""

    def build(pairs):
        return spark.createDataFrame(list(pairs), "src long, dst long")

    return build
