"""The shared working folder."""

from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest

from tickloom.session import new_folder, shared_dir, working_folders
from tickloom.sinks.stage import staged


def session(named=None, checkpoint=None, master="local[2]"):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    context.setCheckpointDir = lambda folder: setattr(context, "set_to", folder)
    conf = SimpleNamespace(get=lambda name, default=None: named or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_named_folder_is_used(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(session("hdfs://x/y")) == "hdfs://x/y"
    assert shared_dir(session(checkpoint="hdfs://z")) == "hdfs://z"


def test_cluster_without_a_folder_is_refused():
    with pytest.raises(ValueError):
        shared_dir(session(master="yarn"))


def test_local_session_gets_one():
    local = session()
    assert shared_dir(local) == local.sparkContext.set_to


def test_folders_are_fresh(spark):
    assert new_folder(spark, "a") != new_folder(spark, "a")


def test_working_folders_are_removed_at_the_end(spark):
    def held():
        return {p.name for p in Path(shared_dir(spark)).iterdir() if p.name.startswith("kept-")}

    before = staged(spark.range(3), "kept")
    known = held()
    with working_folders(spark):
        with working_folders(spark):
            assert staged(spark.range(5), "kept").count() == 5
            new_folder(spark, "kept")  # named, but never written
        assert held() == known
        staged(spark.range(5), "kept")
        assert len(held()) == len(known) + 1
    assert held() == known and before.count() == 3
    with pytest.raises(ZeroDivisionError), working_folders(spark):
        staged(spark.range(5), "kept")
        1 / 0
    assert held() == known
