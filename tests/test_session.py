"""Staging-folder rules: read spark.checkpoint.dir from the session; pick a
folder only for local masters; refuse on a cluster without one."""

import pytest

from aerostar.session import checkpoint_dir, stage_dir


class _Ctx:
    def __init__(self, master, current=None):
        self.master, self._current, self.set_to = master, current, None

    def getCheckpointDir(self):
        return self._current

    def setCheckpointDir(self, path):
        self.set_to = self._current = path


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _Ctx(master, current)
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("yarn"))


def test_configured_folder_is_used():
    s = _Session("yarn", conf={"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert stage_dir(s, "x").startswith("hdfs:///shared/ckpt/aerostar/x-")


def test_existing_context_folder_wins():
    s = _Session("yarn", conf={"spark.checkpoint.dir": "hdfs:///other"}, current="hdfs:///ctx")
    assert checkpoint_dir(s) == "hdfs:///ctx"


def test_local_master_gets_a_folder():
    s = _Session("local[2]")
    assert checkpoint_dir(s) == s.sparkContext.set_to
