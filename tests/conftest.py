"""One local session for all tests."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from tillhouse.session import local_session

    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from compare import connection
    from tables import SF_DIR

    return connection(SF_DIR)
