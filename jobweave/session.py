"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "jobweave", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings every operator assumes.

    AQE does the run-time work the operators rely on: it turns a join into a broadcast join
    only after it has seen the size of a side, and splits the skewed partitions of the others.
    Whatever a cluster sets through ``spark-submit`` (master, shuffle partitions,
    memory, ``spark.checkpoint.dir``) is left alone.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local master may do without: then a temporary folder is made and set. On a cluster such a folder would lie on one
    machine, and reads would miss what others wrote, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not is_local(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    created = tempfile.mkdtemp(prefix="jobweave-")
    spark.sparkContext.setCheckpointDir(created)
    return created


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[n]``); ``local-cluster`` is not."""
    return master == "local" or master.startswith("local[")


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used; it is removed when the Python process ends."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    if not _scratch:
        atexit.register(_remove_scratch)
    _scratch.append((spark, path))
    return path


#: Whether the shuffle files of a query go when it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run inside leave no shuffle files behind."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends there, and any executor can read it. Nothing else of the work stays on disk."""
    path = new_scratch_path(frame.sparkSession, name)
    with swept(frame.sparkSession):
        frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Removes a table that ``written`` gave back and that nothing will read again."""
    spark = table.sparkSession
    for path in {os.path.dirname(f) for f in table.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_scratch: list[tuple[SparkSession, str]] = []


def _remove_scratch() -> None:
    for spark, path in _scratch:
        try:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # noqa: BLE001  the session may be gone, and then nothing can be removed
            return
