"""Table folders: ``{root}/Tables/{schema}/{table}``, replaced as a whole."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from . import snapshots
from .snapshots import KEEP_SECONDS, KEEP_VERSIONS, Pending

# File and row-group limits of the published layout.
ROWS_PER_FILE = 48_000_000
ROWS_PER_GROUP = 16_000_000

#: Views that this process has put on a table's folder, by application and folder.
_views: dict[tuple[str, str], dict[str, str]] = {}


def table_path(root: str, schema: str, table: str) -> str:
    return f"{root.rstrip('/')}/Tables/{schema}/{table}"


def data_path(spark: SparkSession, target: str, groups: frozenset[str] | None = None) -> str:
    """Where the current version's files are; the folder itself if it has no versions."""
    version = snapshots.current(spark, target, groups)
    return version.data if version else target


def read_table(
    spark: SparkSession, root: str, schema: str, table: str, fmt: str = "parquet"
) -> DataFrame:
    """The version that is current now; a replacement later does not change the frame."""
    target = table_path(root, schema, table)
    return spark.read.format(fmt).load(target if fmt == "delta" else data_path(spark, target))


def read_tables(
    spark: SparkSession, root: str, names: Iterable[tuple[str, str]], fmt: str = "parquet"
) -> dict[tuple[str, str], DataFrame]:
    """Several ``(schema, table)``; those that were published together are seen together."""
    groups = snapshots.published_groups(spark, root)
    return {(s, t): spark.read.format(fmt).load(data_path(spark, table_path(root, s, t), groups)) for s, t in names}


def write_version(
    df: DataFrame,
    root: str,
    schema: str,
    table: str,
    fmt: str = "parquet",
    max_records_per_file: int | None = ROWS_PER_FILE,
    max_rows_per_group: int | None = ROWS_PER_GROUP,
    row_group_bytes: int | None = None,
) -> Pending:
    """Write the next version of a table, which no reader sees before :func:`publish`."""
    new = snapshots.prepare(table_path(root, schema, table))
    writer = df.write.format(fmt)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if max_rows_per_group:
        writer = writer.option("parquet.block.row.count.limit", max_rows_per_group)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    try:
        writer.save(new.data)
    except Exception:
        snapshots.discard(df.sparkSession, [new])
        raise
    return new


def publish(
    spark: SparkSession,
    pending: list[Pending],
    root: str,
    keep_versions: int = KEEP_VERSIONS,
    keep_seconds: float = KEEP_SECONDS,
) -> None:
    """Make the versions current at the same moment, move views along, delete what is old."""
    try:
        snapshots.publish(spark, pending, root)
    except Exception:
        snapshots.discard(spark, pending)
        raise
    for new in pending:
        for view, fmt in list(views_on(spark, new.target).items()):
            if spark.catalog.tableExists(view):
                point_view(spark, view, fmt, new.data)
            else:
                del views_on(spark, new.target)[view]
        snapshots.vacuum(spark, new.target, keep_versions, keep_seconds)
    if len(pending) > 1:
        snapshots.vacuum_groups(spark, root, keep_seconds)


def views_on(spark: SparkSession, target: str) -> dict[str, str]:
    """Views of this application on a table folder, with their format."""
    return _views.setdefault((spark.sparkContext.applicationId, target.rstrip("/")), {})


def point_view(spark: SparkSession, view: str, fmt: str, path: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {fmt}.`{path}`")


def write_table(
    df: DataFrame,
    root: str,
    schema: str,
    table: str,
    fmt: str = "parquet",
    max_records_per_file: int | None = ROWS_PER_FILE,
    max_rows_per_group: int | None = ROWS_PER_GROUP,
    row_group_bytes: int | None = None,
    keep_versions: int = KEEP_VERSIONS,
    keep_seconds: float = KEEP_SECONDS,
) -> DataFrame:
    """Replace rows and schema of a table and return the new table.

    Plain files are written as a new version of the table, which becomes the
    current one in one step after every task has succeeded (see :mod:`.snapshots`):
    readers get the old rows or the new ones at any moment, a table can be rebuilt
    from itself, and a failed job leaves the old one untouched and nothing behind.
    Old versions stay for ``keep_seconds``, and ``keep_versions`` of them longer. A
    row group ends at ``max_rows_per_group`` rows or at the format's own number of
    bytes (128 MB unless ``row_group_bytes`` is given), of which each writing task
    holds as much in memory.
    """
    spark = df.sparkSession
    if fmt == "delta":  # the format keeps versions by itself
        target = table_path(root, schema, table)
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").save(target)
        return read_table(spark, root, schema, table, fmt)
    new = write_version(df, root, schema, table, fmt, max_records_per_file, max_rows_per_group, row_group_bytes)
    publish(spark, [new], root, keep_versions, keep_seconds)
    return spark.read.format(fmt).load(new.data)
