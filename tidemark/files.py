"""Folders of the lake, through Hadoop's file systems (whatever scheme the path has)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _located(spark, path)
    return system.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all in it; nothing happens if there is none."""
    system, target = _located(spark, path)
    system.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    system, target = _located(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, target = _located(spark, path)
    stream = system.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, to: str) -> bool:
    """False if the file system refuses, as most do where the new name exists."""
    system, target = _located(spark, path)
    return system.rename(target, spark._jvm.org.apache.hadoop.fs.Path(to))


def make_folder(spark: SparkSession, path: str) -> None:
    system, target = _located(spark, path)
    system.mkdirs(target)


def changed(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with the time of their last change, in milliseconds."""
    system, target = _located(spark, path)
    found = system.listStatus(target) if system.exists(target) else []
    return {status.getPath().getName(): status.getModificationTime() for status in found}


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    system, target = _located(spark, path)
    return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []


def newest_partition(spark: SparkSession, path: str, column: str) -> str | None:
    """The largest value of a partition column by its folders, without opening a file. ISO dates sort as text."""
    prefix = f"{column}="
    found = [name[len(prefix) :] for name in children(spark, path) if name.startswith(prefix)]
    return max((v for v in found if not v.startswith("__HIVE_DEFAULT")), default=None)
