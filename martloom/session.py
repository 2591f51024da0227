"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# A hot join key must be split even when the operator above the join would have
# reused its partitioning; Spark then adds that one shuffle, and only then.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# What one task takes, so that larger tables mean more tasks and not larger ones. Rows of
# keys and cents compress to a few bytes and are sorted and hashed at twenty times that.
TASK_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Turn on runtime skew handling, and bound what a task takes where the session has no
    bound of its own. Nothing here depends on the size of a table."""
    for name, value in SKEW_SETTINGS.items():
        spark.conf.set(name, value)
    given = spark.conf.getAll
    for name, value in TASK_SETTINGS.items():
        if name not in given:
            spark.conf.set(name, value)
    return spark


_trial_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    The setting is fixed when the session is made; it is required in every mode.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or _trial_folder
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def local_trial(spark: SparkSession) -> SparkSession:
    """Use a temporary folder of this machine where the session names none.

    For trial runs in local mode, where all executors are this machine. The library
    never calls it.
    """
    global _trial_folder
    master = spark.sparkContext.master
    local = master == "local" or master.startswith("local[")
    if local and not (spark.conf.get("spark.checkpoint.dir", None) or _trial_folder):
        _trial_folder = tempfile.mkdtemp(prefix="martloom-")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/martloom/{name}-{uuid.uuid4().hex}"


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Remove what ``keep`` writes inside the block when it ends.

    For steps that leave only stored tables behind: frames built on kept tables cannot
    be read afterwards. Blocks may be nested; the outermost one removes.
    """
    if _run_folder.get():
        yield
        return
    folder = scratch_path(spark, "run")
    token = _run_folder.set(folder)
    try:
        yield
    finally:
        _run_folder.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Shuffle partitions that a written result of many rows starts from.
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
FINE = 2000


@contextmanager
def _setting(spark: SparkSession, name: str, value) -> Iterator[None]:
    """Set ``name`` inside the block where the session has no value of its own."""
    if spark.conf.get(name, None):
        yield
        return
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name)


@contextmanager
def fine_shuffles(spark: SparkSession) -> Iterator[None]:
    """Start shuffles inside the block from ``FINE`` partitions where the session names no number.

    Spark merges small partitions but does not split those of an aggregate, so that a task
    grows with the table where their number is small. What runs later is not affected.
    """
    with _setting(spark, INITIAL, FINE):
        yield


# Spark's setting to remove the shuffle files of an execution when it ends.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Remove shuffle files when the write or read they belong to ends, for streams that are
    started inside the block.

    They stay otherwise until the driver happens to collect its garbage: with a large heap,
    those of all batches.
    """
    with _setting(spark, CLEANED, "true"):
        yield


def keep(df: DataFrame, name: str = "kept") -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Used where a result is read several times or where its lineage must end. The
    table is columnar, survives lost executors, and its file sizes tell the planner
    whether it may be broadcast.
    """
    spark = df.sparkSession
    folder = _run_folder.get()
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
