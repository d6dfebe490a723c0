import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, os.path.dirname(HERE), os.environ.get("PYTHONPATH", "")])  # the workers' path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from siltbed.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app="siltbed-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
