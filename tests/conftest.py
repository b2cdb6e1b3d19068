import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakestrata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    return session


@pytest.fixture
def folder():
    """A new folder per test; left to the system to clear."""
    return tempfile.mkdtemp(prefix="run-")
