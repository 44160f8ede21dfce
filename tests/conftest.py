import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from samples import DATA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from peerrank.session import local_session

    s = local_session(4, shuffle_partitions=4, app="peerrank-tests")
    yield s
    s.stop()


@pytest.fixture
def data_path():
    return lambda name: os.path.join(DATA, name)


@pytest.fixture
def tmp_out(tmp_path):
    return lambda name: str(tmp_path / name)
