"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Functions of this package travel to the executors by value, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: White space as all word rules here have it; a word is a run of anything else.
SPACE = " \t\n\x0b\x0c\r"

#: Characters of text that a Python task handles at a time; a longer text goes alone.
CHUNK_CHARS = 2_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns in one struct, so that a caller's names cannot clash with ours."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])


def unpack(df: DataFrame, columns: list[str], struct: str = "_row", more: list[str] | None = None) -> DataFrame:
    """The columns that :func:`whole_row` packed, in their order, and ``more`` if their names are free."""
    free = [c for c in more or [] if c.lower() not in {x.lower() for x in columns}]
    return df.select(*[F.col(struct).getField(c).alias(c) for c in columns], *free)


def row_key(*parts: Column) -> list[Column]:
    """A 128-bit key of a row's content as two columns, null-free.

    Rows that are equal in ``parts`` share it; they get equal results anyway.
    """
    return [
        F.xxhash64(F.lit(17), *parts).alias("_k1"),
        F.xxhash64(F.lit(91), *parts, F.lit(5)).alias("_k2"),
    ]


def map_texts(
    df: DataFrame,
    keep: list[str],
    text: str,
    compute: Callable[[list[str]], list],
    schema: str,
) -> DataFrame:
    """The columns ``keep`` and what ``compute`` gives for the texts, row by row.

    ``compute`` gets the whole texts of a chunk of rows (null as empty) and returns
    a list or array per new column. Arrow bounds a batch, ``CHUNK_CHARS`` what is
    handled at a time.
    """
    fields = [f"`{name}` {kind}" for name, kind in df.select(*keep).dtypes]
    typed = ", ".join([*fields, schema])
    names = StructType.fromDDL(typed).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            start = 0
            while start < len(texts):
                end, size = start + 1, len(texts[start])
                while end < len(texts) and size + len(texts[end]) <= CHUNK_CHARS:
                    size += len(texts[end])
                    end += 1
                made = [pa.array(x) for x in compute(texts[start:end])]
                kept = [batch.column(i).slice(start, end - start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=names)
                start = end

    return df.select(*keep, F.col(text)).mapInArrow(run, typed)
