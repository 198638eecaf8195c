"""Conditional aggregates and value lists per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cond_max(conditions: Mapping[str, Column], value: Column) -> list[Column]:
    """One ``max(value)`` aggregate per named condition."""
    return [F.max(F.when(test, value)).alias(name) for name, test in conditions.items()]


def cond_list(
    df: DataFrame,
    by: Sequence[str],
    value: Column,
    conditions: Mapping[str, Column],
    sep: str = "; ",
    distinct: bool = False,
    copied: bool = True,
) -> DataFrame:
    """Per group and named condition, the values that meet it as one sorted text.

    Copies are counted before any group comes together: the first aggregation
    combines map-side on (group, value), so a group that owns a large share of
    the rows is spread by its values and only distinct values meet in the second.
    That much any single result cell has to hold. A list without values is null.
    Say ``copied=False`` for rows with few copies, whose lists are then as long as their
    groups: the counting and its shuffle are left out, with the same result.
    """
    names = list(conditions)
    # Which conditions a row meets, a bit each.
    marks = F.lit(0).cast("long")
    for i, test in enumerate(conditions.values()):
        marks = marks.bitwiseOR(F.when(test, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    marked = df.select(*by, value.alias("_value"), marks.alias("_marks")).withColumn(
        "_value", F.when(F.col("_marks") != 0, F.col("_value"))
    )
    item = F.struct("_value", "_marks")
    if copied:
        marked = marked.groupBy(*by, "_value", "_marks").agg(F.count(F.lit(1)).cast("int").alias("_copies"))
        item = F.struct("_value", "_marks", "_copies")
    # One list of a group's values, from which each condition takes its own.
    listed = marked.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.when(F.col("_value").isNotNull(), item))).alias("_items")
    )

    def text(i: Column) -> Column:
        return F.concat(F.repeat(F.concat(i["_value"], F.lit(sep)), i["_copies"] - 1), i["_value"])

    def joined(bit: int) -> Column:
        own = F.filter("_items", lambda i: i["_marks"].bitwiseAND(F.lit(bit).cast("long")) != 0)
        items = own["_value"] if distinct or not copied else F.transform(own, text)
        # A value that meets several conditions in several ways comes more than once.
        items = F.array_distinct(items) if distinct and (len(names) > 1 or not copied) else items
        return F.when(F.size(items) > 0, F.array_join(items, sep))

    return listed.select(*by, *[joined(1 << i).alias(n) for i, n in enumerate(names)])


def string_list(
    df: DataFrame, by: Sequence[str], value: Column, out: str, sep: str, distinct: bool = False
) -> DataFrame:
    """All values of a group as one sorted text; null if it has none."""
    return cond_list(df, by, value, {out: F.lit(True)}, sep, distinct)


def sorted_set(value: Column) -> Column:
    """Distinct non-null values, sorted. For values of a small domain per group."""
    return F.sort_array(F.collect_set(value))
