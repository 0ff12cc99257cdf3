import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from histwise.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="histwise-tests")
    yield s
    s.stop()
