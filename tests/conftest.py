import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = os.environ.get("EVENTLOOM_TEST_SF", "/root/testdata/sf0.001")
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from eventloom.session import build_session, drop_scratch
    # tests keep their catalog tables in a private warehouse folder
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="eventloom-wh-")})
    yield s
    drop_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def con_small():
    from compare import duck
    return duck(SF_SMALL)
