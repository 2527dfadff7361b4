import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from sessionloom.functions.lineage import release
    from sessionloom.session import local_session

    s = local_session(8, "6g", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    release(s)
    s.stop()
