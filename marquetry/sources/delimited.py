"""Delimited dumps to typed tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import snapshots
from .concurrent_jobs import run_together
from .scratch import stage
from .snapshots import Pending
from .tables import publish, read_tables, write_version

# The columns that get a type; every other column stays text.
DUMP_TYPES = {
    "primaryTitle": "string",
    "averageRating": "double",
    "numVotes": "bigint",
    "startYear": "bigint",
    "endYear": "bigint",
    "deathYear": "bigint",
    "birthYear": "bigint",
    "runtimeMinutes": "bigint",
    "isAdult": "tinyint",
}


def scan_delimited(
    spark: SparkSession,
    path: str,
    sep: str = "\t",
    null: str = "\\N",
    header: bool = True,
    quote: str = "",
    partitions: int | None = None,
) -> DataFrame:
    """All-text scan. Quoting is off, since a leading ``"`` is data in these dumps.

    A compressed dump is one split; ``partitions`` spreads its rows right after
    the scan so that typing and writing do not stay in that one task.
    """
    df = (
        spark.read.option("sep", sep)
        .option("nullValue", null)
        .option("header", header)
        .option("quote", quote)
        .option("escape", "")
        .option("inferSchema", False)
        .csv(path)
    )
    return df.repartition(partitions) if partitions else df


def cast_present(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Type the columns that exist. Bad text becomes null, or fails if ``strict``."""
    typed = {
        name: F.col(name).cast(kind) if strict else F.col(name).try_cast(kind)
        for name, kind in types.items()
        if name in df.columns
    }
    return df.withColumns(typed)


class BadCellsError(ValueError):
    """Cells that cannot be read as their column's type; ``counts`` by column."""

    def __init__(self, table: str, counts: Mapping[str, int]) -> None:
        self.table, self.counts = table, dict(counts)
        super().__init__(f"{table}: " + ", ".join(f"{n} bad cells in {c}" for c, n in sorted(counts.items())))


#: A ledger without rows.
NO_CELLS = ["'' AS table", "'' AS column", "'' AS raw", "id AS cells"]


def cast_with_ledger(
    df: DataFrame, types: Mapping[str, str], table: str, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`cast_present`, and what became null in them: table, column, raw text, cells.

    Both come from one scan of ``df``, which is staged with each row's bad cells beside
    it (none, nearly always). Their number per column is observed in that pass;
    ``strict`` raises it as :class:`BadCellsError`. A text that is null is no bad cell.
    """
    present = {name: kind for name, kind in types.items() if name in df.columns}

    def is_bad(name: str) -> Column:
        return F.col(name).isNotNull() & F.col(name).try_cast(present[name]).isNull()

    cells = [
        F.when(is_bad(name), F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("raw")))
        for name in present
    ]
    none = F.array().cast("array<struct<column:string,raw:string>>")
    bad = F.array_compact(F.array(*cells)) if cells else none
    typed = df.select(
        *[F.col(c).try_cast(present[c]).alias(c) if c in present else F.col(c) for c in df.columns], bad.alias("_bad")
    )
    seen = Observation()
    counts = [F.coalesce(F.sum(F.size(F.filter("_bad", lambda x: x["column"] == n))), F.lit(0)).alias(n) for n in present]
    staged = stage(typed.observe(seen, F.count(F.lit(1)).alias("_rows"), *counts), "typed")
    found = {name: n for name, n in seen.get.items() if name != "_rows" and n}
    if strict and found:
        raise BadCellsError(table, found)
    ledger = staged.filter(F.size("_bad") > 0).select(F.inline("_bad")).groupBy("column", "raw")
    ledger = ledger.agg(F.count(F.lit(1)).alias("cells"))
    return staged.drop("_bad"), ledger.select(F.lit(table).alias("table"), "column", "raw", "cells")


def bronze_load(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] = DUMP_TYPES,
    strict: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    return cast_present(scan_delimited(spark, path, partitions=partitions), types, strict)


def table_name(path: str) -> str:
    """``…/title.basics.tsv.gz`` → ``t_title_basics``."""
    base = path.rstrip("/").split("/")[-1]
    return "t_" + base.removesuffix(".gz").removesuffix(".tsv").replace(".", "_")


def load_all(
    spark: SparkSession,
    dumps: Mapping[str, str],
    root: str,
    schema: str = "bronze",
    types: Mapping[str, str] = DUMP_TYPES,
    strict: bool = False,
    parallelism: int = 4,
    partitions: int | None = None,
    ledger: str | None = None,
) -> dict[str, DataFrame]:
    """Load ``{table: path}`` concurrently into typed tables, all or none.

    The tables are written side by side as new versions and published together by
    one file, so a reader sees all old or all new ones. If one load fails, the jobs of
    the others are cancelled, what they wrote is deleted, and every table stays as it
    was. Give ``ledger`` the name of a table, and the bad cells of all dumps are written
    to it and published with them (:func:`cast_with_ledger`).
    """
    written: list[Pending] = []
    ledgers: list[DataFrame] = []

    def load(table: str, path: str) -> None:
        if ledger:
            text = scan_delimited(spark, path, partitions=partitions)
            rows, bad = cast_with_ledger(text, types, table, strict)
            ledgers.append(bad)
        else:
            rows = bronze_load(spark, path, types, strict, partitions)
        written.append(write_version(rows, root, schema, table))

    def job(table: str, path: str) -> Callable[[], None]:
        return lambda: load(table, path)

    try:
        run_together(spark, {t: job(t, p) for t, p in dumps.items()}, parallelism)
        if ledger:
            cells = reduce(DataFrame.union, ledgers, spark.range(0).selectExpr(*NO_CELLS))
            written.append(write_version(cells, root, schema, ledger))
    except Exception:
        snapshots.discard(spark, written)
        raise
    publish(spark, written, root)
    names = [*dumps, *([ledger] if ledger else [])]
    return {t: df for (_, t), df in read_tables(spark, root, [(schema, t) for t in names]).items()}
