import os
from types import SimpleNamespace

import pytest

from voltledger.session import new_path, scratch, shared_folder, shuffle_partitions, written


def session(master, setting=None, checkpoint=None):
    context = SimpleNamespace(
        master=master, folder=checkpoint, getCheckpointDir=lambda: context.folder
    )
    context.setCheckpointDir = lambda folder: setattr(context, "folder", folder)
    conf = SimpleNamespace(get=lambda name, default: setting if name == "spark.checkpoint.dir" else default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_setting_of_the_session_comes_first():
    assert shared_folder(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_folder(session("local[2]", "/shared", "/other")) == "/shared"


def test_a_checkpoint_folder_set_by_code_will_do():
    assert shared_folder(session("yarn", None, "hdfs:///set")) == "hdfs:///set"


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))


def test_a_local_session_gets_one_folder():
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)


def test_shuffle_partitions():
    assert shuffle_partitions(0) == 1
    assert shuffle_partitions(128 * 2**20 + 1) == 2
    assert shuffle_partitions(2 * 10**12) == 14902


def test_scratch_takes_what_is_written_and_goes(spark):
    with scratch(spark) as folder:
        made = written(spark.range(5), "numbers")
        assert made.count() == 5 and all(folder in name for name in made.inputFiles())
        with scratch(spark) as inner:
            written(spark.range(2), "more")
            assert inner.startswith(folder)
        assert not os.path.exists(inner.removeprefix("file:")) and made.count() == 5
    assert not os.path.exists(folder.removeprefix("file:"))
    assert new_path(spark, "x").startswith(shared_folder(spark) + "/x-")


def test_scratch_goes_after_an_error(spark):
    with pytest.raises(ZeroDivisionError):
        with scratch(spark) as folder:
            written(spark.range(5), "numbers")
            1 / 0
    assert not os.path.exists(folder.removeprefix("file:"))
