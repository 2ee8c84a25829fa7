import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidewatch.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="4", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def name():
    """A table name no other test uses."""
    import uuid

    return f"t_{uuid.uuid4().hex[:12]}"
