"""Session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames and returns DataFrames. These helpers only exist for tests,
the benchmark and the command-line entry points.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_COLLECTED: ContextVar[list | None] = ContextVar("collected_stages", default=None)


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "rankshelf") -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("RANKSHELF_DRIVER_MEMORY", "16g"))
    )
    off_heap = os.environ.get("RANKSHELF_OFF_HEAP", "")
    if off_heap:
        builder = builder.config("spark.memory.offHeap.enabled", "true").config("spark.memory.offHeap.size", off_heap)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names it and is used as is. Only a plain ``local``
    session without that setting (tests, the benchmark) gets a scratch folder of
    its own; on any other master a missing setting raises, because executors
    could not read each other's machine-local files.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder when the master is {sc.master}")
        configured = tempfile.mkdtemp(prefix="rankshelf-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of ``path`` (works for any store Spark can write)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, removed when the session's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, jpath = _file_system(spark, path)
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return path


def stage(df, name: str, by: str | None = None):
    """Write ``df`` as Parquet under the checkpoint folder, in a folder for each value of column ``by`` if given, and read it back.

    Used for intermediate tables that are read several times: the plan runs
    once, later readers scan compact columnar files (with pruning and size
    statistics), and the lineage is cut, so a lost executor re-reads files
    instead of recomputing the upstream stages.
    """
    path = scratch_dir(df.sparkSession, name) + "/data"
    df.write.mode("errorifexists").parquet(path, partitionBy=by)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    if _COLLECTED.get() is not None:
        _COLLECTED.get().append(out)
    return out


@contextmanager
def collected_stages() -> Iterator[list]:
    """The frames that ``stage`` returns inside the block, as a list, to be deleted together once they are not read any more."""
    token = _COLLECTED.set([])
    try:
        yield _COLLECTED.get()
    finally:
        _COLLECTED.reset(token)


SMALL_BYTES = 16 << 20  # largest written table that is broadcast


def small_enough(staged, limit: int = SMALL_BYTES) -> bool:
    """Are the files of a frame returned by ``stage`` small enough to broadcast? (No job runs.)"""
    fs, jpath = _file_system(staged.sparkSession, staged._staged_at)
    return fs.getContentSummary(jpath).getLength() <= limit


def unstage(*frames) -> None:
    """Delete the files of frames returned by ``stage`` that no later plan reads."""
    for df in frames:
        fs, jpath = _file_system(df.sparkSession, df._staged_at)
        fs.delete(jpath.getParent(), True)


def unstage_folders(df, by: str, values) -> None:
    """Delete the folders of some values of a frame that ``stage`` wrote cut by column ``by``, once no later plan reads them."""
    fs, _ = _file_system(df.sparkSession, df._staged_at)
    for value in values:
        fs.delete(df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{df._staged_at}/{by}={value}"), True)
