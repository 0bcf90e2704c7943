"""The shared folder and written tables."""

from __future__ import annotations

import os

import pytest

from stintlab import staging
from stintlab.staging import new_path, passing, settle, shared_folder
from tests.conftest import rows


def test_the_named_folder_is_used(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_path(spark) != new_path(spark)


def test_settled_table_is_the_same(spark):
    df = spark.createDataFrame(
        [("a", 1, [1.5], float("nan")), (None, 2, None, None)],
        "k string, v int, x array<double>, d double",
    )
    kept = settle(df)
    assert kept.columns == df.columns
    assert [str(r) for r in rows(kept)] == [str(r) for r in rows(df)]
    assert settle(df.limit(0)).count() == 0


def test_settled_table_has_a_known_size(spark):
    """The planner broadcasts a written table by its size on disk."""
    small = settle(spark.range(1000).selectExpr("id % 10 AS k").distinct())
    joined = spark.range(1_000_000).selectExpr("id AS k").join(small, "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


class Session:
    """As much of a session as the choice of a folder looks at."""

    def __init__(self, master, named=None):
        self.conf = self
        self.sparkContext = self
        self.master, self.named, self.applicationId = master, named, f"app-{master}"

    def get(self, key, default=None):
        return self.named or default

    def getCheckpointDir(self):
        return None


def test_clusters_must_name_a_folder():
    for master in ["yarn", "spark://host:7077", "local-cluster[3,2,1024]"]:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Session(master))
        assert shared_folder(Session(master, "hdfs://x/y/")) == "hdfs://x/y"
    mine = shared_folder(Session("local[4]"))
    assert mine == shared_folder(Session("local[4]")) and os.path.isdir(mine)
    assert staging._local_folders["app-local[4]"] == mine


def test_intermediates_pass(spark):
    with passing(spark):
        kept = settle(spark.range(5))
        folder = kept.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        assert kept.count() == 5 and os.path.isdir(folder)
    assert not os.path.exists(folder)
    outside = settle(spark.range(3))
    assert outside.count() == 3


def test_intermediates_pass_after_an_error(spark):
    with pytest.raises(ZeroDivisionError), passing(spark):
        path = new_path(spark)
        spark.range(3).write.parquet(path)
        raise ZeroDivisionError
    assert not os.path.exists(path.removeprefix("file://"))
