"""Equi joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stage


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Keys that a sketch tracks for each shuffle partition, and groups in which sketches are merged.
TRACKED, MERGED_IN = 12, 32


def key_hash(df: DataFrame, on: Sequence[str], other: DataFrame) -> Column:
    """A hash of the key columns of ``df`` that equal keys of ``other`` share, whatever the width of their types."""
    kinds = df.select(*on).union(other.select(*on)).schema
    return F.xxhash64(*[F.col(c).cast(kind.dataType) for c, kind in zip(on, kinds)])


def hot_keys(df: DataFrame, key: Column) -> dict[int, int]:
    """Hashes of the keys with more rows than an average shuffle partition, and their salts.

    A sketch of frequent items is filled per task and merged in two steps, so nothing
    is shuffled per key. With sixteen slots for each of the ``width`` partitions its
    counts are at most 0.22 / ``width`` of the rows too high, and every key above
    0.44 / ``width`` is in it. The estimates are upper bounds, so no key above
    1 / ``width`` is missed, and fewer than 2 ``width`` keys come back, whatever the
    data. The most frequent come first.
    """
    width = shuffle_width(df)
    rows = df.select(key.alias("_key"), F.pmod(F.spark_partition_id(), F.lit(MERGED_IN)).alias("_group"))
    tracked = TRACKED * max(width, MERGED_IN)
    part = rows.groupBy("_group").agg(
        F.expr(f"approx_top_k_accumulate(_key, {tracked})").alias("_sketch"), F.count(F.lit(1)).alias("_rows")
    )
    # Grouped by a constant, since this aggregate fails on a task without any row.
    whole = part.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(_sketch, {tracked})").alias("_sketch"), F.sum("_rows").alias("_rows"))
    found = whole.select(F.expr(f"approx_top_k_estimate(_sketch, {2 * width})").alias("top"), "_rows").collect()
    if not found:
        return {}
    top, total = found[0]
    return {x["item"]: -(-x["count"] * width // total) for x in top if x["count"] * width > total}


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    derived: bool = False,
) -> DataFrame:
    """Join many-to-one ``left`` to ``right`` on equally named columns.

    A pass over the key columns of ``left`` finds its hot keys, null included. Their
    rows are spread over as many salts as the key fills average partitions, and the
    matching right rows are repeated once per salt; all other keys keep salt 0.
    Without a hot key it is the plain join. Say ``derived`` if ``left`` is expensive
    to make, and it is written once and read for both. ``how`` is ``inner``, ``left``,
    ``left_semi`` or ``left_anti``.
    """
    on = list(on)
    left = stage(left, "skewed") if derived else left
    hot = hot_keys(left, key_hash(left, on, right))
    if not hot:
        return left.join(right, on, how)
    # Bounded by the number of shuffle partitions; a row without hot key is not looked up in it.
    table = F.map_from_arrays(F.lit(list(hot)), F.lit(list(hot.values())))

    def salts(key: Column) -> Column:
        return F.when(key.isin(list(hot)), F.element_at(table, key)).otherwise(1)

    # Copies of one row spread too: the hash is mixed with the input partition.
    mixed = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in hashable(left)])
    salted = left.withColumn("_salt", F.pmod(mixed, salts(key_hash(left, on, right))).cast("int"))
    repeated = F.sequence(F.lit(0), salts(key_hash(right, on, left)).cast("int") - 1)
    one = right.withColumn("_salt", F.explode(repeated))
    return salted.join(one, [*on, "_salt"], how).drop("_salt")


def anti_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], derived: bool = False
) -> DataFrame:
    """Left rows without a partner; copies of right keys are combined map-side."""
    on = list(on)
    return skew_join(left, right.select(*on).distinct(), on, "left_anti", derived)


def hashable(df: DataFrame) -> list[str]:
    """Columns that ``xxhash64`` accepts."""
    return [n for n, t in df.dtypes if "map<" not in t and t != "variant"]


def filtered_left_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], right_filter: Column
) -> DataFrame:
    """One-to-many left join whose ON clause also filters the right side.

    Left rows without a passing partner stay; the filter reaches the right scan.
    An outer join cannot split a hot right key, so the result is the salted inner
    part and the left rows without partner.
    """
    on = list(on)
    kept = right.filter(right_filter)
    columns = [*left.columns, *[c for c in right.columns if c not in on]]
    matched = skew_join(kept, left, on).select(*columns)
    return matched.unionByName(anti_join(left, kept, on), allowMissingColumns=True)
