import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from filigree.runtime import local_session

    session = local_session("filigree-tests", cores="4", memory="4g", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def smoke():
    return "/root/testdata/sf0.001"
