"""Columns to rows and predicates to flag columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import yes_no


def flag_columns(conditions: Mapping[str, Column]) -> list[Column]:
    """One Y/N column per named condition."""
    return [yes_no(test).alias(name) for name, test in conditions.items()]


def explode_list(df: DataFrame, column: str, out: str, sep: str = ",", outer: bool = False) -> DataFrame:
    """One row per item of a separated text, other columns kept, ``column`` dropped.

    A null text gives no row, or one row with a null item if ``outer``.
    """
    items = F.split(F.col(column), sep)
    item = F.explode_outer(items) if outer else F.explode(items)
    return df.withColumn("_item", item).drop(column).withColumnRenamed("_item", out)


def unpivot_lists(
    df: DataFrame, key: str, labels: Mapping[str, str], label: str, item: str, sep: str = ","
) -> DataFrame:
    """``{label: column}`` of separated texts → rows (key, label, item)."""
    wide = df.select(key, *[F.col(column).alias(name) for name, column in labels.items()])
    long = wide.unpivot([key], list(labels), label, "_list")
    return explode_list(long, "_list", item, sep)
