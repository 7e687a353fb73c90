"""The shared checkpoint folder rule: the session setting wins; a cluster
without one is an error; only local mode gets its own folder."""

import pytest

from recoflow.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _SC:
    def __init__(self, master, conf):
        self.master, self._conf, self._dir = master, _Conf(conf), None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d


class _Spark:
    def __init__(self, master, conf=None):
        self.sparkContext = _SC(master, conf or {})


def test_cluster_setting_wins():
    s = _Spark("spark://master:7077", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert checkpoint_dir(s) == "hdfs://nn/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs://nn/ckpt"


def test_cluster_without_setting_fails():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Spark("yarn"))


def test_local_gets_its_own_folder():
    s = _Spark("local[4]")
    d = checkpoint_dir(s)
    assert d and s.sparkContext.getCheckpointDir() == d
    assert checkpoint_dir(s) == d  # reused, not a new folder each call
