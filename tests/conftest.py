import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sieveflow.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="sieveflow-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_state(tmp_path):
    return str(tmp_path / "state")
