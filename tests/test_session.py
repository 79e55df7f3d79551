from pathlib import Path
from types import SimpleNamespace

import pytest

from flowengine import session as settings
from flowengine.session import work_path


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_work_goes_to_the_shared_folder():
    spark = session("yarn", "hdfs://shared/checkpoints/")
    first, second = work_path(spark, "flows"), work_path(spark, "flows")
    assert first.startswith("hdfs://shared/checkpoints/flows-") and first != second


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_path(session("yarn"), "flows")


def test_a_local_session_may_use_a_temporary_folder():
    assert "flowengine-" in work_path(session("local[2]"), "flows")


def test_work_folders_can_be_removed(spark, monkeypatch):
    monkeypatch.setattr(settings, "_made", {})
    path, _ = (work_path(spark, name) for name in ("one", "two"))
    spark.range(3).write.parquet(path)
    assert Path(path).exists()
    assert settings.remove_work(spark) == 2 and not Path(path).exists()
    assert settings.remove_work(spark) == 0
