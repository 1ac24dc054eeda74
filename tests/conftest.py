import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers inherit this: they must import partflow and the test helpers.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from partflow.session import local_session
    s = local_session("*", 8)
    yield s
    s.stop()
