import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from traveltiers.session import checkpoint_dir, get_session

    s = get_session("local[4]", app="traveltiers-tests", **{"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # the session's folder when configured, else a private one (local mode)
    yield s
