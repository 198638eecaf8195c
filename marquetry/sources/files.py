"""File-system access through the session's Hadoop configuration.

Works on whatever store the cluster is set up for, not only local disk.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(hadoop_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def create(spark: SparkSession, path: str) -> None:
    """An empty file; fails if there is one of that name."""
    file_system(spark, path).create(hadoop_path(spark, path), False).close()


@dataclass(frozen=True)
class Entry:
    name: str
    modified: float  # seconds since the epoch


def listed(spark: SparkSession, folder: str) -> list[Entry]:
    """What lies directly in a folder; nothing if it does not exist."""
    fs, path = file_system(spark, folder), hadoop_path(spark, folder)
    found = fs.listStatus(path) if fs.exists(path) else []
    return [Entry(f.getPath().getName(), f.getModificationTime() / 1000) for f in found]


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders matching a glob; used on table level, so a few per table."""
    found = file_system(spark, pattern).globStatus(hadoop_path(spark, pattern)) or []
    return [f.getPath().toString() for f in found if f.isDirectory()]


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    return file_system(spark, path).getContentSummary(hadoop_path(spark, path)).getLength()
