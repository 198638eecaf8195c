"""Scans, writes, loads, views, scratch folder."""

from __future__ import annotations

import gzip
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marquetry.plans.crew import clustered
from marquetry.sources import scratch
from marquetry.sources.delimited import bronze_load, cast_present, load_all, scan_delimited, table_name
from marquetry.sources.tables import data_path, read_table, table_path, write_table


def dump(path, *lines):
    with gzip.open(path, "wt") as out:
        out.write("\n".join(lines) + "\n")
    return str(path)


def test_quotes_backslashes_and_nulls_are_data(spark, tmp_path):
    path = dump(tmp_path / "x.tsv.gz", "id\ttitle\tnote", '1\t"Open\tx', '2\ta "b" c\t\\N', "3\tback\\slash\\\t\\\\N", "4\t 'sp' \ty")
    got = [tuple(r) for r in scan_delimited(spark, path).orderBy("id").collect()]
    assert got == [("1", '"Open', "x"), ("2", 'a "b" c', None), ("3", "back\\slash\\", "\\\\N"), ("4", " 'sp' ", "y")]


def test_repartition_spreads_one_file(spark, tmp_path):
    path = dump(tmp_path / "y.tsv.gz", "id", *map(str, range(1000)))
    spread = scan_delimited(spark, path, partitions=4)
    assert spread.rdd.getNumPartitions() == 4 and spread.count() == 1000
    assert scan_delimited(spark, path).rdd.getNumPartitions() == 1


def test_types_lenient_and_strict(spark, tmp_path):
    path = dump(tmp_path / "z.tsv.gz", "startYear\tisAdult\tother", "1999\t1\t5", "abc\t\\N\t\\N")
    lenient = bronze_load(spark, path)
    assert lenient.dtypes == [("startYear", "bigint"), ("isAdult", "tinyint"), ("other", "string")]
    assert [tuple(r) for r in lenient.collect()] == [(1999, 1, "5"), (None, None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bronze_load(spark, path, strict=True).collect()
    assert cast_present(lenient.select("other"), {"missing": "bigint"}).columns == ["other"]


def test_table_names():
    assert table_name("/raw/title.basics.tsv.gz") == "t_title_basics"
    assert table_name("name.basics.tsv") == "t_name_basics"


def test_load_failure_is_raised(spark, tmp_path):
    good = dump(tmp_path / "a.tsv.gz", "id", "1")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_all(spark, {"t_a": good, "t_b": str(tmp_path / "missing.tsv.gz")}, str(tmp_path / "lake"))


def test_replaced_as_a_whole(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(10).withColumn("a", F.lit(1)), root, "silver", "t")
    again = write_table(read_table(spark, root, "silver", "t").select("id", (F.col("id") * 2).alias("b")), root, "silver", "t")
    assert again.columns == ["id", "b"] and again.agg(F.sum("b")).first()[0] == 90
    left = {s for s in os.listdir(tmp_path / "Tables") if os.listdir(tmp_path / "Tables" / s)}
    assert left == {"silver"}


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(5), root, "silver", "t")
    with pytest.raises(Exception):
        write_table(spark.range(5).withColumn("x", F.raise_error(F.lit("no"))), root, "silver", "t")
    assert read_table(spark, root, "silver", "t").count() == 5


def test_file_and_group_limits(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(0, 10_000, 1, 1), root, "s", "t", max_records_per_file=4000, max_rows_per_group=1500)
    folder = data_path(spark, table_path(root, "s", "t"))
    found = [pq.ParquetFile(f"{folder}/{f}").metadata for f in os.listdir(folder) if f.endswith(".parquet")]
    assert sorted(m.num_rows for m in found) == [2000, 4000, 4000]
    assert max(m.row_group(i).num_rows for m in found for i in range(m.num_row_groups)) <= 1500


def test_clustered_files_have_separate_name_ranges(spark, tmp_path):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 700)).alias("name"),
        F.col("id").alias("tconst"),
        F.lit("actor").alias("category"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        spans = (
            clustered(rows.repartition(6))
            .groupBy(F.spark_partition_id().alias("p"))
            .agg(F.min("name").alias("lo"), F.max("name").alias("hi"), F.count_if(F.col("name") == "hot").alias("hot"))
            .orderBy("p")
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))
    # The hot name does not stay in one partition.
    assert sum(r["hot"] > 0 for r in spans) > 1 and sum(r["hot"] for r in spans) == 3000


def test_scratch_uses_the_session_folder(spark, tmp_path):
    root = scratch.scratch_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir", root).rstrip("/")
    staged = scratch.stage(spark.range(3), "few")
    assert staged.count() == 3
    path = staged.inputFiles()[0]
    folder = os.path.dirname(path.removeprefix("file:").replace("//", ""))
    assert folder.startswith(root.removeprefix("file:")) and os.path.isdir(folder)
    scratch.release(spark)
    assert not os.path.exists(folder)
