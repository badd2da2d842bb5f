import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ordermill.session import get_session

    s = get_session("local[4]", app="ordermill-tests", shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
