"""Session defaults, the shared folder and its clean-up."""

import os
import subprocess
import sys

import pytest

from cinelake import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_submitted_sizes_survive():
    code = (
        "from cinelake.session import build_session; s = build_session(); "
        "print('SET', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.files.maxPartitionBytes'), "
        "s.conf.get('spark.sql.streaming.stateStore.providerClass').rsplit('.', 1)[1]); s.stop()"
    )
    args = "--master local[1] --conf spark.sql.shuffle.partitions=4000 --conf spark.sql.files.maxPartitionBytes=77m pyspark-shell"
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": args}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180).stdout
    assert "SET 4000 77m RocksDBStateStoreProvider" in out


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "_configured_checkpoint_dir", lambda s: None)
    monkeypatch.setattr(session, "_master", lambda s: "yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(spark, "x")


def test_scratch_folders_go(spark):
    with session.scratch(spark):
        kept = session.materialize(spark.range(3), "scratch")
        path = kept.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)
