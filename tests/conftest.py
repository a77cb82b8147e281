import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlight.session import build_session
    extra = {"spark.driver.memory": "8g"}
    # build_session keeps the session's spark.checkpoint.dir; only where it is
    # unset (local mode) does it pick a private folder
    s = build_session("local[8]", shuffle_partitions=8, app_name="ledgerlight-tests", extra=extra)
    yield s
    s.stop()
