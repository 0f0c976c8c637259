"""Scratch folder: shared on a cluster, temporary only locally; dropped on request."""

import os

import pytest

from tickwork.fsutil import local_fs_path, qualified
from tickwork.operators.series import materialize
from tickwork.sinks import drop_scratch, scratch_mark, scratch_path
from tickwork.sinks.scratch import shared_dir


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, **conf):
        self.sparkContext, self._conf = _Context(master), conf
        self.conf = self

    def get(self, key, default=None):
        return self._conf.get(key, default)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]", "k8s://x"])
def test_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session(master))
    assert shared_dir(_Session(master, **{"spark.checkpoint.dir": "hdfs://n/c/"})) == "hdfs://n/c"


@pytest.mark.parametrize("master", ["local", "local[*]", "local[4]"])
def test_local_session_gets_a_folder(master):
    assert os.path.isdir(local_fs_path(shared_dir(_Session(master))))


def test_scratch_tables_can_be_dropped(spark):
    kept, mark = scratch_path(spark, "kept"), scratch_mark()
    spark.range(3).write.parquet(kept)
    materialize(spark.range(5))
    gone = scratch_path(spark, "gone")
    spark.range(2).write.parquet(gone)
    assert drop_scratch(spark, mark) == 2
    assert not os.path.exists(local_fs_path(gone)) and spark.read.parquet(kept).count() == 3


def test_paths_are_resolved_like_sparks_own(spark, tmp_path):
    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert qualified(spark, f"file://{tmp_path}") == f"file:{tmp_path}" or qualified(spark, f"file://{tmp_path}").endswith(str(tmp_path))
