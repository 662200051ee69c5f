"""Work-folder resolution."""

import pytest

from billing_guard import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value if self.value is not None else default


class _Context:
    def __init__(self, folder=None, master="local[2]"):
        self.folder, self.master = folder, master

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder + "/uuid"


class _Session:
    def __init__(self, conf_value, context_folder=None):
        self.conf = _Conf(conf_value)
        self.sparkContext = _Context(context_folder)


def test_configured_folder_wins():
    s = _Session("/shared/ckpt/")
    assert session.work_root(s) == "/shared/ckpt"
    assert s.sparkContext.folder == "/shared/ckpt/uuid"


def test_fallback_registers_context_folder_only():
    s = _Session(None)
    root = session.work_root(s)
    assert root.startswith("/") and "billing_guard-" in root
    assert s.sparkContext.folder.startswith(root)
    assert session.work_root(_Session(None)) == root   # one private folder per process


def test_work_paths_are_unique(spark):
    assert session.work_path(spark, "x") != session.work_path(spark, "x")


def test_a_cluster_needs_a_shared_folder():
    s = _Session(None)
    s.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(s)
    s = _Session("/shared/ckpt")
    s.sparkContext.master = "spark://host:7077"
    assert session.work_root(s) == "/shared/ckpt"


def test_paths_are_qualified_like_spark_resolves_them(spark):
    from billing_guard.session import qualified

    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert qualified(spark, "/user/x") == "file:/user/x" and qualified(spark, "file:/a/b") == "file:/a/b"
    conf.set("fs.defaultFS", "hdfs://names:8020")
    try:
        assert qualified(spark, "/user/x/work") == "hdfs://names:8020/user/x/work"
        assert qualified(spark, "file:///a/b") == "file:/a/b"
    finally:
        conf.set("fs.defaultFS", before)
