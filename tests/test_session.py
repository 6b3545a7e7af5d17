from pathlib import Path
from types import SimpleNamespace

import pytest

from discolake import session


class Conf(dict):
    def set(self, key, value):
        self[key] = value


def fake(master, **conf):
    return SimpleNamespace(conf=Conf(conf), sparkContext=SimpleNamespace(master=master))


def test_the_folder_of_the_cluster_is_used():
    spark = fake("yarn", **{"spark.checkpoint.dir": "s3a://shared/tmp/"})
    folder = session.new_folder(spark, "run")
    assert folder.startswith("s3a://shared/tmp/run-")
    assert folder != session.new_folder(spark, "run")


def test_a_cluster_without_one_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(fake("yarn"))


def test_a_local_session_gets_one_of_its_own():
    spark = fake("local[2]")
    root = session.shared_root(spark)
    assert Path(root).is_dir() and session.shared_root(spark) == root


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.ui.enabled") == "false"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
