"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tidemark import files

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Tables stored inside the innermost scratch() of this thread.
_stored: ContextVar[list[str] | None] = ContextVar("stored", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local session without one gets a folder of its own.

    On a cluster a temporary folder of the machine is refused; a mounted folder that all machines share is not.
    """
    context = spark.sparkContext
    local = context.master.startswith("local")
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not folder:
        if not local:
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        folder = context.getCheckpointDir()
    if not local and _of_this_machine(_located(spark, folder)):
        raise RuntimeError(f"{CHECKPOINT_DIR} is {folder}, a temporary folder that other machines do not see")
    return folder.rstrip("/")


def _located(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Hadoop gives it: one without is on the default file system."""
    if getattr(spark, "_jvm", None) is None:
        return folder
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _of_this_machine(folder: str) -> bool:
    """Whether a file: path lies under a temporary folder."""
    path = folder.removeprefix("file://").removeprefix("file:")
    if path == folder:
        return False
    return any(f"{path}/".startswith(f"{top}/") for top in ("/tmp", "/var/tmp", tempfile.gettempdir()))


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, outlives: bool = False, compression: str | None = None) -> DataFrame:
    """Write once and read back: later passes see the same rows even after executors are lost.

    A Parquet table rather than a checkpoint, so that a pass over one column reads one column and the
    optimizer knows the true size. One that ``outlives`` the scratch() around it is left when that ends. Without a
    ``compression`` the session's holds.
    """
    path = fresh_path(df.sparkSession, label)
    if not outlives and (stored := _stored.get()) is not None:
        stored.append(path)
    df.write.parquet(path, compression=compression)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def drop(table: DataFrame) -> None:
    """Remove a table that :func:`materialise` returned and that nothing reads any more."""
    files.remove(table.sparkSession, table.stored_at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that :func:`materialise` stores inside, also after a failure. Nothing read lazily from them
    may be used afterwards."""
    stored: list[str] = []
    token = _stored.set(stored)
    try:
        yield
    finally:
        _stored.reset(token)
        for path in stored:
            files.remove(spark, path)
