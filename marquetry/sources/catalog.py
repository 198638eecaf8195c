"""Make every table folder under a root queryable as ``schema.table``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import files
from .tables import data_path, point_view, table_path, views_on


def register_views(
    spark: SparkSession,
    root: str,
    schema: str | None = None,
    table: str | None = None,
    fmt: str = "parquet",
    prefix: str = "",
) -> DataFrame:
    """(Re)create one view per table folder; returns the (schema, table) pairs.

    Views only point at the files of a table's current version, so replacing one
    never touches data. When this application replaces a table, its views move to
    the new version; run this again where another one did. ``prefix`` stands before
    the names of the databases, so several roots can be registered side by side.
    Views of the asked schemas and tables whose folder is gone are dropped.
    """
    found = []
    for path in files.folders(spark, table_path(root, schema or "*", table or "*")):
        sch, tbl = path.rstrip("/").split("/")[-2:]
        if sch.startswith("_"):
            continue
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{sch}`")
        view = f"`{prefix}{sch}`.`{tbl}`"
        point_view(spark, view, fmt, path if fmt == "delta" else data_path(spark, path))
        views_on(spark, table_path(root, sch, tbl))[view] = fmt
        found.append((sch, tbl))
    asked = [schema] if schema else sorted({s for s, _ in found})
    for sch in asked:
        if spark.catalog.databaseExists(f"{prefix}{sch}"):
            for view in spark.catalog.listTables(f"{prefix}{sch}"):
                wanted = table is None or view.name.lower() == table.lower()
                if view.tableType == "VIEW" and wanted and (sch, view.name) not in found:
                    spark.sql(f"DROP VIEW `{prefix}{sch}`.`{view.name}`")
    return spark.createDataFrame(sorted(found), "schema string, table string")
