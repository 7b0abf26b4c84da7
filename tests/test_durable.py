from __future__ import annotations

from types import SimpleNamespace

import pytest

from tidemark import files
from tidemark.durable import CHECKPOINT_DIR, _located, drop, fresh_path, materialise, scratch, shared_folder


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"{folder}/of-this-application"


class Session:
    """Just the settings of a session."""

    def __init__(self, master, settings):
        self.sparkContext = Context(master)
        self.conf = SimpleNamespace(get=settings.get)


def test_the_folder_of_the_cluster_is_used():
    assert shared_folder(Session("yarn", {CHECKPOINT_DIR: "hdfs:///shared/"})) == "hdfs:///shared"
    assert fresh_path(Session("yarn", {CHECKPOINT_DIR: "hdfs:///shared"}), "x").startswith("hdfs:///shared/x-")


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match=CHECKPOINT_DIR):
        shared_folder(Session("spark://host:7077", {}))


def test_a_local_session_gets_its_own():
    session = Session("local[2]", {})
    assert shared_folder(session) == shared_folder(session)


def test_materialised_rows_read_back(spark):
    df = spark.range(10).selectExpr("id", "id % 3 AS k")
    assert sorted(materialise(df, "t").collect()) == sorted(df.collect())


def test_a_table_may_have_its_own_codec(spark):
    table = materialise(spark.range(10), "t", compression="zstd")
    names = files.children(spark, table.stored_at)
    assert table.count() == 10 and all(n.endswith(".zstd.parquet") for n in names if n.startswith("part-"))


def test_tables_that_outlive_and_tables_that_are_dropped(spark):
    with scratch(spark):
        gone, kept = materialise(spark.range(3), "gone"), materialise(spark.range(4), "kept", outlives=True)
    assert not files.exists(spark, gone.stored_at) and kept.count() == 4
    drop(kept)
    assert not files.exists(spark, kept.stored_at)


def test_a_folder_without_scheme_is_on_the_default_file_system(spark):
    assert _located(spark, "/tmp/x") == "file:/tmp/x" and _located(spark, "file:///mnt/y") == "file:/mnt/y"
