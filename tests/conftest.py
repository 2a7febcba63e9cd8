import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from homeward.session import checkpoint_dir, local_session

    s = local_session(cores="4", shuffle_partitions=8, app="homeward-tests")
    checkpoint_dir(s, str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
