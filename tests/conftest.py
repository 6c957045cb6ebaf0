import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from foldmark.session import local_session

    session = local_session(8, "foldmark-tests", shuffle_partitions=4)
    yield session
    session.stop()
