"""Checkpoint folder rules: use the configured shared folder; invent one only
in local mode."""

import pytest

from tillsight.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, _Conf(conf), None

    def getCheckpointDir(self):  # noqa: N802 - mirrors SparkContext
        return self.dir

    def getConf(self):  # noqa: N802
        return self._conf

    def setCheckpointDir(self, d):  # noqa: N802
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})
        self.conf = _Conf(conf or {})


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_cluster_uses_configured_folder():
    s = _Session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_mode_may_use_a_temporary_folder():
    assert ensure_checkpoint_dir(_Session("local[2]")).startswith("/")
