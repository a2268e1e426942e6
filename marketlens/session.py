"""Session settings, stored intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that Spark expects of a table up to which it is broadcast.
BROADCAST_BYTES = 32 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Runtime SQL settings the plans in this package count on."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one in local runs only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="marketlens-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


class _Written(threading.local):
    """Paths that a thread has stored: builds that run at a time don't delete each other's."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_WRITTEN = _Written()


def written() -> int:
    """How many tables `durable` has written in this thread and not deleted."""
    return len(_WRITTEN.paths)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables that `durable` wrote in this thread, but for the first `since` of them."""
    paths, _WRITTEN.paths[since:] = _WRITTEN.paths[since:], []
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession) -> str:
    """A new path in the checkpoint folder; `release` deletes what is written there."""
    _WRITTEN.paths.append(f"{checkpoint_folder(spark)}/marketlens-{uuid.uuid4().hex}")
    return _WRITTEN.paths[-1]


def discard(spark: SparkSession, path: str) -> None:
    """Delete one table written to a `scratch_path` that is read no more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _WRITTEN.paths.remove(path)


def durable(df: DataFrame, reader: SparkSession | None = None, rows_of_a_file: int = 0) -> DataFrame:
    """The same rows as a table written to the checkpoint folder.

    Cuts the lineage for results that are read more than once or whose columns depend on
    the partitioning: they are computed once and keep their values when executors are lost.
    Read back as Parquet, they have a known size and prunable columns. `reader` is the session that
    reads them, `rows_of_a_file` the most rows of a file."""
    spark = df.sparkSession
    path = scratch_path(spark)
    writer = df.write.option("maxRecordsPerFile", rows_of_a_file) if rows_of_a_file else df.write
    writer.parquet(path)
    return (reader or spark).read.schema(df.schema).parquet(path)


def file_by_file(spark: SparkSession) -> SparkSession:
    """A session with the same settings whose scans put no two files in a task. Where files hold a
    bounded number of rows, so do its tasks, however well the rows compress."""
    reader = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            reader.conf.set(key, value)
    # A file counts as its bytes and this cost, so two never fit a task.
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        reader.conf.set(key, "32m")
    return reader


def expected_bytes(df: DataFrame) -> int:
    """The size the optimizer expects, from the sizes of the files; no job is run. Without such
    sizes it is enormous."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if `df` is expected to have at most `limit` bytes; beyond that the
    join is left to Catalyst, which shuffles it."""
    return F.broadcast(df) if expected_bytes(df) <= limit else df
