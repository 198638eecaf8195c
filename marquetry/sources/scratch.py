"""Intermediate tables in the folder shared by driver and executors.

A staged table cuts lineage and survives the loss of any executor, since its
files live in the cluster's ``spark.checkpoint.dir``, or below the warehouse
where that is unset.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from . import files

#: The scratch of the running block, also seen by the threads of ``run_together``.
_current: ContextVar[Scratch | None] = ContextVar("scratch", default=None)
#: What is staged outside any block, by application.
_open: dict[str, Scratch] = {}


class Scratch:
    """Owns the tables that one run stages."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def path(self, label: str) -> str:
        made = f"{scratch_root(self.spark)}/{label}-{uuid.uuid4().hex}"
        self.paths.append(made)
        return made

    def release(self) -> None:
        while self.paths:
            files.remove(self.spark, self.paths.pop())


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def owner(spark: SparkSession) -> Scratch:
    current = _current.get()
    return current or _open.setdefault(spark.sparkContext.applicationId, Scratch(spark))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Tables staged inside the block are deleted at its end, also after a failure.

    Blocks are independent of each other: what one stages, no other deletes. Frames
    that read a table of the block fail after it, so write results inside.
    """
    own = Scratch(spark)
    token = _current.set(own)
    try:
        yield own
    finally:
        _current.reset(token)
        own.release()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted with its owner's other paths."""
    return owner(spark).path(label)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of what was written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what this application staged outside any :func:`scratch` block."""
    _open.pop(spark.sparkContext.applicationId, Scratch(spark)).release()
