import pytest

from kudosflow.session import SETTINGS, scratch_path, shared_folder


class Session:
    """Just the settings of a session, some of which cannot change in a real one."""

    def __init__(self, **conf):
        self.conf = {name.replace("__", "."): value for name, value in conf.items()}


def test_the_cluster_names_the_shared_folder():
    session = Session(spark__master="yarn", spark__checkpoint__dir="hdfs://name/folder/")
    assert shared_folder(session) == "hdfs://name/folder/"
    first, second = (scratch_path(session, "t") for _ in range(2))
    assert first.startswith("hdfs://name/folder/kudosflow-")
    assert first != second


def test_without_a_name_only_one_machine_uses_a_temporary_folder():
    warehouse = "s3://lake/warehouse"
    cluster = Session(spark__master="yarn", spark__sql__warehouse__dir=warehouse)
    assert shared_folder(cluster) == warehouse
    several = Session(spark__master="local-cluster[2,1,1024]", spark__sql__warehouse__dir=warehouse)
    assert shared_folder(several) == warehouse
    assert "kudosflow-" in shared_folder(Session(spark__master="local[2]"))


def test_a_cluster_does_not_use_a_folder_of_one_machine():
    for folder in ("file:/home/me/spark-warehouse", "file:///tmp/w", "/home/me/warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Session(spark__master="yarn", spark__sql__warehouse__dir=folder))
    hdfs = {"spark__hadoop__fs__defaultFS": "hdfs://name", "spark__sql__warehouse__dir": "/lake"}
    assert shared_folder(Session(spark__master="yarn", **hdfs)) == "/lake"


def test_settings_are_in_force(spark):
    assert all(spark.conf.get(name) == value for name, value in SETTINGS.items())
