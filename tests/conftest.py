import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8)
    shared_dir(s)  # uses spark.checkpoint.dir, or registers a private folder when unset
    yield s


SMALL = "/root/testdata/sf0.001"
