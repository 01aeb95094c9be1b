from types import SimpleNamespace

import pytest

from themelake.session import build_session, configure, cut_lineage, scratch, shared_dir


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, named=None):
    conf = SimpleNamespace(get=lambda key, default=None: named or default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master))


def test_the_named_folder_is_used(spark):
    assert shared_dir(fake("spark://x", "hdfs://n/shared/")) == "hdfs://n/shared"
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/themelake/x-")
    assert scratch(spark, "x") != scratch(spark, "x")


def test_a_cluster_needs_the_setting_a_local_session_does_not():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake("yarn"))
    local = fake("local[2]")
    assert shared_dir(local) == shared_dir(local) != ""


def test_settings(spark):
    assert build_session("again") is not None
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_cut_lineage_keeps_the_rows(spark, plan):
    df = cut_lineage(spark.range(10).where("id > 3"))
    assert df.count() == 6 and "Range" not in plan(df)
