import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from orderpulse.session import local_session

    session = local_session("orderpulse-tests", 4, partitions=4)
    yield session
    session.stop()
