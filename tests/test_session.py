"""The shared folder and staged rows."""

import os
from types import SimpleNamespace

import pytest

from tidewell.__main__ import session_options
from tidewell.session import iceberg_catalog_options, new_workspace, shared_folder, staged, staged_while


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/id"


def session(master, configured=None, current=None):
    conf = SimpleNamespace(get=lambda name, default: configured if name == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=FakeContext(master, current))


def test_shared_folder_comes_from_the_session():
    assert shared_folder(session("yarn", "hdfs://nn/shared/")) == "hdfs://nn/shared"
    assert shared_folder(session("yarn", None, "hdfs://nn/cp/id")) == "hdfs://nn/cp/id"


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_local_session_gets_one_folder():
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local) != ""


def test_staged_rows_are_read_back_with_their_schema(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, TIMESTAMP '2024-01-01 00:00:00' AS c")
    again = staged(df, "t")
    assert [(f.name, f.dataType) for f in again.schema] == [(f.name, f.dataType) for f in df.schema]
    assert again.collect() == df.collect()
    assert new_workspace(spark, "x") != new_workspace(spark, "x")


def test_staged_folder_goes_with_the_block(spark):
    with staged_while(spark.range(5), "t") as rows:
        folder = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert rows.count() == 5 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_catalog_options():
    options = iceberg_catalog_options("lake", "s3a://w", "impl", "io", {"uri": "u"})
    assert options["spark.sql.defaultCatalog"] == "lake"
    assert options["spark.sql.catalog.lake.uri"] == "u"
    assert options["spark.sql.catalog.lake.warehouse"] == "s3a://w"


def test_configuration_registers_the_catalog():
    config = {"store": {"warehouse": "s3a://w", "catalog": "lake"}, "catalog": {"catalog_impl": "impl"}}
    options = session_options({**config, "session": {"spark.sql.defaultCatalog": "other", "x": "y"}})
    assert options["spark.sql.catalog.lake.catalog-impl"] == "impl"
    assert (options["spark.sql.defaultCatalog"], options["x"]) == ("other", "y")
    assert session_options({"store": {"warehouse": "w"}}) == {}
    with pytest.raises(ValueError, match=r"store\.catalog"):
        session_options({**config, "store": {"warehouse": "w"}})
