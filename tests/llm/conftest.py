import pytest

from lakestrata.llm.common import give_back


@pytest.fixture(autouse=True)
def own_memory_only():
    """Memory that earlier tests have freed is not counted as a test's own when it starts."""
    give_back()
