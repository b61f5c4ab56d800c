import os
import subprocess
import sys

import pytest

from ledgerline.session import drop_scratch, scratch_path, shuffle_partitions_for, size_shuffles


class FakeSession:
    """A session whose checkpoint folder can be left unset."""

    def __init__(self, master, setting=None):
        self.setting, self.folder = setting, None
        self.conf = self.sparkContext = self
        self.master = master

    def get(self, key, default):
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_uses_the_named_folder():
    path = scratch_path(FakeSession("spark://host:7077", "s3a://bucket/shared/"), "x")
    assert path.startswith("s3a://bucket/shared/x-")


def test_scratch_refuses_a_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(FakeSession("spark://host:7077"), "x")


def test_scratch_makes_one_local_folder():
    session = FakeSession("local[2]")
    first, second = scratch_path(session, "x"), scratch_path(session, "x")
    assert first != second
    assert os.path.dirname(first) == os.path.dirname(second) == session.folder


def test_dropped_scratch_is_gone(spark):
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions_for(1) == 8
    assert shuffle_partitions_for(100 << 40) == 4 * 819_200


def test_jobs_size_their_shuffles_only_where_the_user_did_not(spark):
    # the session of the tests was given a number
    assert size_shuffles(spark, 100 << 40) is None
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_settings_of_the_user_stay(tmp_path):
    """In a process of its own, submitted with settings as a user would."""
    code = (
        "from ledgerline.session import create_session, size_shuffles, stored_bytes\n"
        "s = create_session('x', 'local[1]')\n"
        f"s.range(1000).write.parquet(r'{tmp_path}/t')\n"
        f"n = size_shuffles(s, 1 << 30); assert stored_bytes(s, r'{tmp_path}/t') > 0\n"
        "c = s.conf.get\n"
        "print('GOT', c('spark.sql.session.timeZone'), c('spark.sql.adaptive.enabled'),"
        " c('spark.sql.adaptive.skewJoin.enabled'), n, c('spark.sql.shuffle.partitions'))"
    )
    args = "--conf spark.sql.session.timeZone=Asia/Tokyo --conf spark.sql.adaptive.enabled=false --conf spark.ui.enabled=false pyspark-shell"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": args, "PYTHONPATH": root}
    out = subprocess.run(
        [sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=120
    ).stdout
    assert "GOT Asia/Tokyo false true 32 32" in out
