"""Scans, writes, reads, views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.crew import clustered
from ..sources.catalog import register_views
from ..sources.delimited import cast_present, cast_with_ledger, load_all, scan_delimited, table_name
from ..sources.layout import write_planned
from ..sources.manifest import paged_search
from ..sources.scratch import scratch_path
from ..sources.tables import data_path, read_table, table_path, write_table
from .registry import check, table


def dump(df: DataFrame, path: str) -> None:
    """Write a gzip dump with header, tab separated, nulls as ``\\N``, no quoting."""
    df.write.options(
        sep="\t", header=True, nullValue="\\N", quote="", compression="gzip"
    ).csv(path)


@check(
    "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part"
)
def scan_tsv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "part")
    dump(table(spark, sf, "part"), path)
    types = {"p_partkey": "bigint", "p_size": "bigint", "p_retailprice": "double"}
    return cast_present(scan_delimited(spark, path), types)


@check("""
    SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_quantity,
           CASE WHEN l_returnflag <> 'A' THEN l_tax END AS l_tax
    FROM lineitem""", "cast_present")
def cast_present_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    text = table(spark, sf, "lineitem").select(
        *[F.col(c).cast("string").alias(c) for c in ("l_orderkey", "l_linenumber", "l_quantity")],
        F.when(F.col("l_returnflag") == "A", F.lit("n/a"))
        .otherwise(F.col("l_tax").cast("string"))
        .alias("l_tax"),
    )
    types = {"l_orderkey": "bigint", "l_quantity": "double", "l_tax": "double", "l_absent": "bigint"}
    return cast_present(text, types)


def _spoiled(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as text, with cells that are no numbers, or none of their type."""
    columns = ("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    text = table(spark, sf, "lineitem").select(*[F.col(c).cast("string").alias(c) for c in columns], "l_returnflag")
    return text.withColumns(
        {
            "l_tax": F.when(F.col("l_returnflag") == "A", F.concat(F.lit("n/a "), "l_linenumber")).otherwise(F.col("l_tax")),
            "l_linenumber": F.when(F.col("l_linenumber") == "7", F.lit("300")).otherwise(F.col("l_linenumber")),
            "l_quantity": F.when(F.col("l_quantity") == "9.0", F.lit(None)).otherwise(F.col("l_quantity")),
        }
    )


@check("""
    SELECT 't_lines' AS table_name, 'l_tax' AS column_name, 'n/a ' || l_linenumber AS raw, count(*) AS cells
    FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_linenumber
    UNION ALL SELECT 't_lines', 'l_linenumber', '300', count(*) FROM lineitem WHERE l_linenumber = 7 HAVING count(*) > 0
    UNION ALL SELECT 'rows', 'all', CAST(count(*) FILTER (l_returnflag = 'A') AS VARCHAR), count(*) FROM lineitem""")
def cast_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Every text that became null in a typed table, and what the table itself has."""
    types = {"l_orderkey": "bigint", "l_linenumber": "tinyint", "l_quantity": "double", "l_tax": "double", "l_none": "int"}
    rows, ledger = cast_with_ledger(_spoiled(spark, sf), types, "t_lines")
    whole = rows.agg(
        F.lit("rows"), F.lit("all"), F.count_if(F.col("l_tax").isNull()).cast("string"), F.count(F.lit(1))
    )
    return ledger.union(whole).toDF("table_name", "column_name", "raw", "cells")


@check("""
    WITH total AS (SELECT count(*) AS n FROM lineitem),
         plan AS (SELECT n, greatest(least(16, n // 1000), 1, CAST(ceil(n / 6000) AS BIGINT)) AS files FROM total),
         rows AS (SELECT row_number() OVER () - 1 AS i FROM lineitem),
         sizes AS (SELECT (i * files) // n AS file, count(*) AS n_rows FROM rows, plan GROUP BY 1),
         per AS (SELECT CAST(ceil(n / files) AS BIGINT) AS per_file FROM plan),
         limits AS (SELECT CAST(ceil(per_file / ceil(per_file / 2000)) AS BIGINT) AS per_group FROM per)
    SELECT n_rows, CAST(ceil(n_rows / per_group) AS BIGINT) AS n_groups, least(n_rows, per_group) AS most_in_group,
           count(*) AS n_files
    FROM sizes, limits GROUP BY ALL""")
def planned_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and row groups of the files of a planned table, from their footers; limits scaled down."""
    root = scratch_path(spark, "lake")
    lines = table(spark, sf, "lineitem")
    order = [F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_linenumber")]
    write_planned(lines, root, "silver", "t_lines", order, width=16, least_group=1000, most_group=2000, most_file=6000)
    return footers(spark, data_path(spark, table_path(root, "silver", "t_lines"))).groupBy(
        "n_rows", "n_groups", "most_in_group"
    ).agg(F.count(F.lit(1)).alias("n_files"))


def footers(spark: SparkSession, path: str) -> DataFrame:
    """Rows, row groups and the largest row group of each Parquet file below a path."""

    def read(batches):
        import io

        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            found = [pq.ParquetFile(io.BytesIO(x.as_py())).metadata for x in batch.column(0)]
            sizes = [[m.row_group(i).num_rows for i in range(m.num_row_groups)] for m in found]
            columns = [[sum(s) for s in sizes], [len(s) for s in sizes], [max(s, default=0) for s in sizes]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["n_rows", "n_groups", "most_in_group"])

    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("content")
    return content.mapInArrow(read, "n_rows bigint, n_groups bigint, most_in_group bigint")


@check("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate
    FROM orders""")
def write_read_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    orders = table(spark, sf, "orders")
    first = write_table(orders.withColumnRenamed("o_orderstatus", "status"), root, "silver", "orders")
    # Rebuilt from itself with another schema.
    again = first.withColumnRenamed("status", "o_orderstatus").withColumn(
        "o_orderdate", F.to_date("o_orderdate").cast("string")
    )
    write_table(again, root, "silver", "orders", max_records_per_file=1_000_000)
    return read_table(spark, root, "silver", "orders")


_FIVE = ["region", "nation", "supplier", "customer", "part"]


@check(
    " UNION ALL ".join(f"SELECT 't_{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _FIVE)
)
def load_all_counts(spark: SparkSession, sf: str) -> DataFrame:
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    dumps = {}
    for name in _FIVE:
        path = f"{raw}/{name}.tsv.gz"
        dump(table(spark, sf, name), path)
        dumps[table_name(path)] = path
    loaded = load_all(spark, dumps, root, types={})
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in loaded.items()
    ]
    return reduce(DataFrame.union, counts)


def _lake(spark: SparkSession, sf: str) -> str:
    root = scratch_path(spark, "lake")
    for schema, name in (("bronze", "part"), ("silver", "orders"), ("gold", "customer")):
        write_table(table(spark, sf, name), root, schema, f"t_{name}")
    return root


@check("""
    SELECT 'bronze' AS sch, 't_part' AS tbl, count(*) AS n_rows FROM part
    UNION ALL SELECT 'silver', 't_orders', count(*) FROM orders
    UNION ALL SELECT 'gold', 't_customer', count(*) FROM customer
    UNION ALL SELECT 'other_silver', 't_orders', count(*) FROM orders WHERE o_orderstatus = 'F'""")
def registered_views(spark: SparkSession, sf: str) -> DataFrame:
    root, other = _lake(spark, sf), scratch_path(spark, "lake")
    # A second root with other rows under the same names; one of its tables is asked for.
    finished = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    for schema, name in (("silver", "t_orders"), ("silver", "t_more"), ("gold", "t_orders")):
        write_table(finished, other, schema, name)
    views = register_views(spark, root)
    more = register_views(spark, other, schema="silver", table="t_orders", prefix="other_")
    views = views.union(more.withColumn("schema", F.concat(F.lit("other_"), "schema")))
    counts = [
        spark.table(f"{s}.t_{t}")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(s).alias("schema"), F.lit(f"t_{t}").alias("table"), "n_rows")
        for s, t in (("bronze", "part"), ("silver", "orders"), ("gold", "customer"), ("other_silver", "orders"))
    ]
    return views.join(reduce(DataFrame.union, counts), ["schema", "table"]).select(
        F.col("schema").alias("sch"), F.col("table").alias("tbl"), "n_rows"
    )


@check("""
    SELECT c_mktsegment, o_orderstatus, count(*) AS n_orders, CAST(max(c_custkey) AS BIGINT) AS last_cust
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def sql_over_views(spark: SparkSession, sf: str) -> DataFrame:
    register_views(spark, _lake(spark, sf))
    return spark.sql("""
        SELECT c_mktsegment, o_orderstatus, count(*) AS n_orders, max(c_custkey) AS last_cust
        FROM silver.t_orders JOIN gold.t_customer ON o_custkey = c_custkey GROUP BY ALL""")


@check("""
    WITH t AS (SELECT c_mktsegment, count(*) AS total FROM customer GROUP BY 1),
         n AS (SELECT *, unnest(range(1, total + 1, 50)) AS n FROM t)
    SELECT c_mktsegment, total, 'search?in=' || c_mktsegment || '&place=' || n || ',' || (n + 49) AS url
    FROM n""")
def manifest_paged(spark: SparkSession, sf: str) -> DataFrame:
    totals = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("total"))
    prefix = F.concat(F.lit("search?in="), "c_mktsegment", F.lit("&place="))
    return paged_search(totals, "total", 50, prefix)


@check("SELECT p_name AS name, p_partkey AS tconst, p_type AS category FROM part")
def clustered_write(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select(
        F.col("p_name").alias("name"), F.col("p_partkey").alias("tconst"), F.col("p_type").alias("category")
    )
    return write_table(clustered(rows), scratch_path(spark, "lake"), "silver", "t_crew")
