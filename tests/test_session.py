from types import SimpleNamespace

import pytest

from quayline.errors import MissingParameterError
from quayline.session import configure, scratch_path, scratch_root, staged


def fake(shared=None, master="local[2]"):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_shared_folder_comes_from_the_session():
    assert scratch_root(fake("hdfs://n/shared/", "spark://m")) == "hdfs://n/shared"


def test_temporary_folder_in_local_mode_only():
    assert scratch_root(fake()) == scratch_root(fake())
    with pytest.raises(MissingParameterError):
        scratch_root(fake(master="spark://m"))


def test_paths_are_fresh():
    assert scratch_path(fake("/s"), "x") != scratch_path(fake("/s"), "x")


def test_settings_are_applied(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_staged_rows_no_longer_depend_on_their_source(spark):
    df = staged(spark, spark.range(10), "t")
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().executedPlan().toString()
