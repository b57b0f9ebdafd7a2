import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FIXTURES = os.path.join(ROOT, "tests", "fixtures")


@pytest.fixture(scope="session")
def spark():
    from rentalytics.session import local_session
    s = local_session("*", shuffle_partitions=8, app="tests")
    yield s
    s.stop()


@pytest.fixture
def fixtures():
    return FIXTURES
