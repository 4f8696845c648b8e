"""The shared work folder: read from the session, fresh sub-folders per use."""

from sitelens.session import scratch_path, work_root


def test_work_root_reads_the_configured_checkpoint_folder(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured and work_root(spark) == configured


def test_scratch_paths_are_fresh_and_below_the_work_root(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    root = work_root(spark).rstrip("/")
    assert a != b and a.startswith(root + "/x-") and b.startswith(root + "/x-")


class _Conf(dict):
    def get(self, k, default=None):
        return dict.get(self, k, default)


class _SC:
    def __init__(self, master):
        self.master, self._dir = master, None

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return _Conf()


class _Session:
    def __init__(self, master):
        self.sparkContext, self.conf = _SC(master), _Conf()


def test_unset_work_root_local_gets_a_private_folder_cluster_refuses():
    import pytest
    local = _Session("local[4]")
    d = work_root(local)
    assert d and d == local.sparkContext.getCheckpointDir()
    with pytest.raises(RuntimeError):
        work_root(_Session("yarn"))
