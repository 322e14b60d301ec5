import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from shelfwise.session import build_session, checkpoint_dir

    s = build_session("local[4]", 4, app_name="shelfwise-tests", driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # the cluster setting if present, else a fresh local folder
    yield s
