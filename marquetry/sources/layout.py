"""Planned file layout: how many files of how many rows, in row groups of what size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import files
from .scratch import scratch_path
from .tables import ROWS_PER_FILE, ROWS_PER_GROUP, publish, read_table, write_version

# The least rows of a row group of the published layout.
LEAST_ROWS_PER_GROUP = 8_000_000
#: Bytes of a row group that a writing task may hold.
GROUP_BYTES = 1 << 30

# monotonically_increasing_id() keeps the place within the partition in these bits.
_PLACE_BITS = 33


@dataclass(frozen=True)
class Layout:
    rows: int
    files: int
    rows_per_group: int
    group_bytes: int
    fits: bool  # whether groups of that many rows stay below group_bytes, by the staged size

    @property
    def rows_per_file(self) -> int:
        return -(-self.rows // self.files)


def plan_layout(
    rows: int,
    stored_bytes: int,
    width: int,
    least_group: int = LEAST_ROWS_PER_GROUP,
    most_group: int = ROWS_PER_GROUP,
    most_file: int = ROWS_PER_FILE,
    group_bytes: int = GROUP_BYTES,
) -> Layout:
    """About ``width`` files, but none above ``most_file`` rows and, if there are as
    many, none below ``least_group``; groups between ``least_group`` and ``most_group``,
    of which the latter must be twice the former at least.

    Files and the groups of a file get equal shares, so there is no short last one.
    """
    if most_group < 2 * least_group or most_file < most_group:
        raise ValueError("limits leave some numbers of rows without a layout")
    fewest, most = max(1, -(-rows // most_file)), max(1, rows // least_group)
    count = min(max(width, fewest), max(most, fewest))
    per_file = -(-rows // count) if rows else 1
    per_group = -(-per_file // -(-per_file // most_group))
    return Layout(rows, count, per_group, group_bytes, stored_bytes * per_group <= group_bytes * max(rows, 1))


def write_planned(
    df: DataFrame,
    root: str,
    schema: str,
    table: str,
    order: Sequence[Column] = (),
    width: int | None = None,
    least_group: int = LEAST_ROWS_PER_GROUP,
    most_group: int = ROWS_PER_GROUP,
    most_file: int = ROWS_PER_FILE,
    group_bytes: int = GROUP_BYTES,
) -> tuple[DataFrame, Layout]:
    """Replace a table by files of the planned layout, sorted by ``order`` across files if given.

    The rows are staged once (range-partitioned and sorted), which gives the rows and
    bytes of each partition; a row's number among all then says which file it goes to,
    so file boundaries are exact, also inside one value of ``order``. Only the counts
    per partition meet in one task. ``width`` is by default the number of shuffle
    partitions.
    """
    spark = df.sparkSession
    width = width or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    path = scratch_path(spark, "layout")
    ordered.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    part = F.shiftright("_place", _PLACE_BITS)
    counts = sorted(placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    total, before = 0, {}
    for number, n in counts:
        before[number] = total
        total += n
    stored = files.size(spark, path)
    layout = plan_layout(total, stored, width, least_group, most_group, most_file, group_bytes)
    if total:
        # As many entries as the staged write had tasks.
        offsets = spark.range(len(before)).select(
            F.get(F.lit(list(before)), F.col("id").cast("int")).alias("_part"),
            F.get(F.lit(list(before.values())), F.col("id").cast("int")).alias("_before"),
        )
        numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        number = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
        dealt = numbered.withColumn("_row", number)
        dealt = dealt.withColumn("_file", F.expr(f"int((_row * {layout.files}L) div {total}L)"))
        dealt = dealt.repartitionById(layout.files, "_file").sortWithinPartitions("_row")
    else:
        dealt = placed.coalesce(1)
    new = write_version(
        dealt.select(*[F.col(f"`{c}`") for c in df.columns]), root, schema, table,
        max_records_per_file=None, max_rows_per_group=layout.rows_per_group, row_group_bytes=group_bytes,
    )
    publish(spark, [new], root)
    return read_table(spark, root, schema, table), layout
