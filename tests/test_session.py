from __future__ import annotations

import os
import time

import pytest

from jobweave import session


class Cluster:
    """What ``shared_dir`` asks of a session, as a cluster without a shared folder would answer."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "spark://head:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())
    assert [session.is_local(m) for m in ("local", "local[4]", "local-cluster[2,1,900]", "yarn")] == [True, True, False, False]


def test_scratch_paths_lie_in_the_shared_folder_and_are_removed(spark):
    path = session.new_scratch_path(spark, "rows")
    assert os.path.dirname(path) == session.shared_dir(spark).removeprefix("file:")
    spark.range(3).write.parquet(path)
    keep = list(session._scratch)
    session._scratch[:] = [(spark, path)]
    session._remove_scratch()
    session._scratch[:] = [x for x in keep if x[1] != path]
    assert not os.path.exists(path.removeprefix("file:"))


def test_a_written_table_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = manager.getAllFiles().mkString("\n").count("shuffle_")
    rows = session.written(spark.range(5000).repartition(7, "id"), "rows")
    for _ in range(100):
        if manager.getAllFiles().mkString("\n").count("shuffle_") <= before:
            break
        time.sleep(0.1)
    assert manager.getAllFiles().mkString("\n").count("shuffle_") <= before
    assert rows.count() == 5000 and spark.conf.get(session.CLEANUP) == "false"
