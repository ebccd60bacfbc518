from types import SimpleNamespace

import pytest

from rebasket.session import fresh_path, shared_dir, stored


def fake(conf, used, master):
    chosen = {"dir": used}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: chosen["dir"],
        setCheckpointDir=lambda d: chosen.update(dir=d),
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf), sparkContext=context)


def test_the_named_folder_wins():
    assert shared_dir(fake("hdfs://shared/x/", "/other", "yarn")) == "hdfs://shared/x"
    assert shared_dir(fake(None, "hdfs://shared/y", "yarn")) == "hdfs://shared/y"


def test_only_a_local_session_falls_back():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake(None, None, "spark://master"))
    session = fake(None, None, "local[2]")
    assert shared_dir(session) == shared_dir(session)


def test_stored_rows_come_back(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    back = stored(rows, "rows")
    assert back.schema == rows.schema
    assert sorted(back.collect()) == sorted(rows.collect())
    assert fresh_path(spark, "a") != fresh_path(spark, "a")
