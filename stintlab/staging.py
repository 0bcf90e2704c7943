"""Small intermediate tables, written where every executor can read them again.

A written table has three uses here: its values stay the same however often it is read
(sums of doubles may differ in the last digit between two evaluations), lost executors do
not bring its whole lineage back, and the planner knows its size on disk. The last one is
what decides joins with it: below ``spark.sql.autoBroadcastJoinThreshold`` Spark
broadcasts it, above it Spark shuffles both sides and splits skewed partitions.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# The folder a local session without a named one got, by application.
_local_folders: dict[str, str] = {}
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a folder of its own; the session's own checkpoint
    folder is left alone. ``local-cluster`` masters count as clusters. A ``file:`` folder is
    taken at its word: it may be a mount that all executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="stintlab-")
    return _local_folders[application]


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing has been written to."""
    path = f"{shared_folder(spark)}/stintlab-{uuid.uuid4().hex}"
    written = _written.get()
    if written is not None:
        written.append(path)
    return path


def settle(df: DataFrame, path: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = path or new_path(spark)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove what was written to some paths, if anything was."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for name in paths:
        path = hadoop.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is written to the shared folder inside the block is removed at its end.

    Save the result inside the block: a table that reads intermediates cannot be read
    once they are gone.
    """
    mark = _written.set([])
    try:
        yield
    finally:
        paths = _written.get() or []
        _written.reset(mark)
        discard(spark, *paths)
