"""Tables written between steps, in the folder the whole cluster shares."""

from __future__ import annotations

import functools
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tallymark.sources import files

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)
_writing = threading.Lock()
_writers: dict[object, tuple[int, str]] = {}  # of a session: threads that write just now, and its setting before


@functools.cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tallymark-{application_id}-")


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the one set on the context.

    A temporary one only for a session without executors of its own in which neither is set.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return f"{folder.rstrip('/')}/{context.applicationId}"
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if context.master == "local" or context.master.startswith("local["):
        return _local_folder(context.applicationId)
    raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_run_folder.get() or scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_scratch(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for the tables that this thread writes meanwhile. It is removed at the end, however that comes,
    so nothing that is still to be computed may leave the block."""
    folder = scratch_path(spark, "run")
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        files.remove(spark, folder)


@contextmanager
def outside_run(folder: str) -> Iterator[None]:
    """Inside a :func:`run_scratch`, whose folder this is: what is written here goes to where that folder is, and stays."""
    token = _run_folder.set(folder.rpartition("/")[0])
    try:
        yield
    finally:
        _run_folder.reset(token)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a table or output that is written here go when it is written. Else they fill the executors' disks until
    the driver happens to collect its memory; nobody reads them again, since any other use of the rows is a plan of its own.

    The setting is the session's, which other threads may write with.
    """
    session = spark._jsparkSession
    with _writing:
        count, before = _writers.get(session) or (0, spark.conf.get(CLEAN_SHUFFLES, "false"))
        _writers[session] = count + 1, before
        spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        with _writing:
            count, before = _writers.pop(session)
            if count > 1:
                _writers[session] = count - 1, before
            else:
                spark.conf.set(CLEAN_SHUFFLES, before)


def write_through(df: DataFrame, name: str, *, compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Unlike a cached DataFrame the table outlives lost executors, is read by column, and gives the planner its true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_packed(df: DataFrame, name: str) -> DataFrame:
    """As :func:`write_through`, for large tables: of texts that cost more to move than to compress, behind shuffles that go."""
    with shuffles_removed(df.sparkSession):
        return write_through(df, name, compression="zstd")
