import pytest

from clickpath.session import REQUIRED_CONF, configure, new_work_dir, shared_dir


def test_work_dirs_live_under_the_checkpoint_dir(spark):
    base = spark.sparkContext.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]
    assert shared_dir(spark) == base
    a, b = new_work_dir(spark, "x"), new_work_dir(spark, "x")
    assert a.startswith(base + "/clickpath/x-") and a != b


def test_configure_sets_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == REQUIRED_CONF["spark.sql.session.timeZone"]


def test_shared_dir_needs_a_setting_off_local():
    import types

    from clickpath.session import shared_dir
    spark = types.SimpleNamespace(
        sparkContext=types.SimpleNamespace(getCheckpointDir=lambda: None, master="spark://somewhere:7077"),
        conf=types.SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(spark)


def test_work_dirs_are_made_and_removed(spark):
    import os

    from clickpath.session import new_work_dir, remove_dir
    path = new_work_dir(spark, "t").replace("file:", "")
    assert os.path.isdir(path)
    remove_dir(spark, path)
    assert not os.path.exists(path)
