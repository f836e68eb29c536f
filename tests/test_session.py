import pytest

from tablewright import session


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no context")  # like Spark Connect


def test_work_root_uses_checkpoint_dir():
    s = _Session({"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/", "spark.master": "yarn"})
    assert session.work_root(s) == "hdfs://nn/shared/ckpt/tablewright"
    assert session.scratch_path(s, "x").startswith("hdfs://nn/shared/ckpt/tablewright/x-")


def test_work_root_refuses_local_folder_on_a_cluster(monkeypatch):
    monkeypatch.setattr(session, "_local_root", None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(_Session({"spark.master": "spark://host:7077"}))


def test_unique_names():
    assert session.unique_table_name("a") != session.unique_table_name("a")
