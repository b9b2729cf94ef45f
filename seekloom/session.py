"""Session settings, and where intermediate tables go."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch between Spark and a Python worker, see ``small_batches``.
BATCH_BYTES = 2 * 1024 * 1024
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Says whether shuffle files go when a query ends, see ``freed_shuffles``.
FREED_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_folder: str | None = None
#: Scratch folders that are open, the innermost last.
_scratch: ContextVar[tuple[str, ...]] = ContextVar("scratch", default=())


def local_session(cores: str = "8", app_name: str = "seekloom") -> SparkSession:
    """A session for one machine. On a cluster, bring the cluster's own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds meanwhile."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile hands rows to Python workers in batches of about ``BATCH_BYTES``.

    Spark's bound of 64 MB is reached by long texts. A batch is held by the executor and, more
    than once, by the worker, and neither gives all of that memory back. A longer row is a batch
    of its own. It is the action that counts, not where a DataFrame was made.
    """
    with _setting(spark, BATCH_KEY, str(BATCH_BYTES)):
        yield


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile deletes its shuffle files when it ends.

    Else they lie on the disks until the driver collects its garbage, and steps that follow each
    other fill the disks together. What was written is read instead of them.
    """
    with _setting(spark, FREED_KEY, "true"):
        yield


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, which all executors can reach.

    Where none is named, a session on one machine gets a temporary folder of its own; on a
    cluster that folder would exist on one machine only, so it is refused.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="seekloom-")
    return _own_folder


def new_folder(spark: SparkSession, label: str, up: int = 0) -> str:
    """A fresh path under the shared folder, in the innermost scratch folder or ``up`` levels above it."""
    open_ = _scratch.get()
    parents = open_[: len(open_) - up]
    return f"{(parents[-1] if parents else shared_folder(spark)).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, up: int = 0) -> DataFrame:
    """Write the rows to the shared folder and read them back from there.

    The result survives the loss of executors and no longer depends on its inputs.
    """
    spark = df.sparkSession
    path = new_folder(spark, "rows", up)
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, as the location of a database that is dropped."""
    name = f"seekloom_{uuid.uuid4().hex}"
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{quoted}'")
    spark.sql(f"DROP DATABASE {name} CASCADE")


@contextmanager
def scratch(spark: SparkSession, label: str = "scratch", delete: bool = True) -> Iterator[str]:
    """A folder for what is stored meanwhile; it is deleted at the end, or left to the caller.

    What is to last longer is stored with ``cut_lineage(..., up=1)``.
    """
    folder = new_folder(spark, label)
    token = _scratch.set((*_scratch.get(), folder))
    try:
        yield folder
    finally:
        _scratch.reset(token)
        if delete:
            remove_folder(spark, folder)


def scratched(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Store a function's result; what it stored on the way is deleted.

    Its first argument is a DataFrame.
    """

    @functools.wraps(function)
    def run(df: DataFrame, *args, **more) -> DataFrame:
        with scratch(df.sparkSession):
            return cut_lineage(function(df, *args, **more), up=1)

    return run
