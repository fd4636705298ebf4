import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from quern.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("quern-tests", "local[8]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
