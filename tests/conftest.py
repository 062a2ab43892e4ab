import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import checkpoint_root, local_session
    s = local_session("*", shuffle_partitions=8, app_name="kestrel-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # sets a mktemp folder only when the session has none
    yield s
    s.stop()
