import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cinelake.session import build_session

    s = build_session(
        "local[4]",
        app_name="cinelake-tests",
        shuffle_partitions=8,
        # catalogue tables created by tests live in a temporary warehouse
        extra_conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cinelake-test-warehouse-")},
    )
    # tests run without a cluster: give the session its own checkpoint folder
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cinelake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
