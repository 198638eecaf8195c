"""Row numbers: first per group, and over a whole table without a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stage

# monotonically_increasing_id() keeps the row's place within its partition in the
# low 33 bits and the partition number above them.
_PLACE_BITS = 33


def top1_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group under ``order``.

    The filter on the row number becomes a group limit before the shuffle, so
    each task sends at most one row per group, however large the group is.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dist_row_number(
    df: DataFrame,
    order: Sequence[Column],
    out: str,
    n_parts: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` as a distributed job.

    Rows are range-partitioned and sorted by the whole key, staged once with
    their place in their partition, and shifted by the size of the partitions
    before theirs. End ``order`` with a unique column: it makes the numbering
    deterministic and lets the range split a value that dominates the first keys.
    ``n_parts`` overrides the session's number of shuffle partitions. Only the columns
    ``keep`` (all, by default) are staged; what is only sorted by need not be.
    """
    kept = list(keep) if keep else df.columns
    width = [n_parts] if n_parts else []
    ranged = df.repartitionByRange(*width, *order).sortWithinPartitions(*order)
    columns = [F.col(f"`{c}`") for c in kept]
    placed = stage(ranged.select(*columns, F.monotonically_increasing_id().alias("_place")), "ranked")

    part = F.shiftright("_place", _PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # At most one row per range partition reaches this window and the broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*columns, (F.col("_before") + place + 1).alias(out))
    )


def cond_rank(
    df: DataFrame,
    flag: Column,
    order: Sequence[Column],
    out: str,
    default: int = 9999,
    behind: Column | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Rank by (flagged first, then ``order``); rows without the flag get ``default``.

    Flagged rows come first, so ranking them alone gives the same numbers and
    the other rows are never sorted. Flagged rows that are ``behind`` sort after
    all rows without the flag (their keys are worse than the keys those are given),
    so the number of these is added. The result has the columns ``keep`` (all, by
    default) and the rank.
    """
    marked = F.coalesce(flag, F.lit(False))
    kept = list(keep) if keep else df.columns
    flagged, others = df.filter(marked), df.filter(~marked)
    if behind is None:
        ranked = dist_row_number(flagged, order, out, keep=kept)
    else:
        flagged = flagged.withColumn("_behind", behind)
        ranked = dist_row_number(flagged, order, out, keep=[*kept, "_behind"])
        skipped = others.agg(F.count(F.lit(1))).scalar()
        ranked = ranked.withColumn(out, F.col(out) + F.when(F.col("_behind"), skipped).otherwise(F.lit(0))).drop("_behind")
    rest = others.select(*[F.col(f"`{c}`") for c in kept]).withColumn(out, F.lit(default).cast("bigint"))
    return ranked.unionByName(rest)
