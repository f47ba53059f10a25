"""The shared folder comes from the session; only a local master may do without."""

from types import SimpleNamespace

import pytest

from parley import session


class FakeContext:
    def __init__(self, master, configured=None):
        self.master, self.configured, self.folder = master, configured, None

    def getConf(self):
        return {"spark.checkpoint.dir": self.configured} if self.configured else {}

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, configured=None):
    conf = SimpleNamespace(get=lambda key, default=None: default)
    return SimpleNamespace(sparkContext=FakeContext(master, configured), conf=conf)


def test_configured_folder_is_used():
    spark = fake("spark://host:7077", "hdfs:///shared/")
    assert session.shared_dir(spark) == "hdfs:///shared"
    assert spark.sparkContext.folder == "hdfs:///shared/"
    assert session.scratch_path(spark, "x").startswith("hdfs:///shared/parley/x-")


def test_cluster_without_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("yarn"))


def test_local_master_falls_back():
    assert "parley-" in session.shared_dir(fake("local[2]"))


def test_cut_lineage_keeps_rows(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS d")
    cut = session.cut_lineage(df)
    assert cut.schema.names == df.schema.names
    assert sorted(cut.collect()) == sorted(df.collect())
    assert "Range" not in cut._jdf.queryExecution().executedPlan().toString()
