"""Versions of tables: readers during replaces, publication together, loads as a whole."""

from __future__ import annotations

import gzip
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from marquetry.sources import snapshots
from marquetry.sources.catalog import register_views
from marquetry.sources.concurrent_jobs import run_together
from marquetry.sources.delimited import BadCellsError, load_all
from marquetry.sources.layout import plan_layout, write_planned
from marquetry.sources.tables import (
    data_path,
    publish,
    read_table,
    read_tables,
    table_path,
    write_table,
    write_version,
)


def numbers(spark, version: int, n: int = 400):
    return spark.range(0, n, 1, 4).withColumn("v", F.lit(version))


def test_a_reader_never_fails_nor_sees_a_mixture(spark, tmp_path):
    """A reader in a loop during 20 replaces."""
    root, seen, failed, over = str(tmp_path), [], [], threading.Event()
    write_table(numbers(spark, 0), root, "silver", "t")

    def read():
        while not over.is_set():
            try:
                seen.append(tuple(read_table(spark, root, "silver", "t").agg(F.count("id"), F.min("v"), F.max("v")).first()))
            except Exception as error:  # whatever a reader may meet
                failed.append(error)

    readers = [threading.Thread(target=read) for _ in range(2)]
    for reader in readers:
        reader.start()
    for version in range(1, 21):
        write_table(numbers(spark, version), root, "silver", "t", keep_versions=1)
    over.set()
    for reader in readers:
        reader.join()
    assert not failed and len(seen) > 5
    assert all(n == 400 and low == high for n, low, high in seen)
    assert read_table(spark, root, "silver", "t").first()["v"] == 20


def test_a_planned_frame_keeps_its_version(spark, tmp_path):
    root = str(tmp_path)
    first = write_table(numbers(spark, 1), root, "silver", "t")
    write_table(numbers(spark, 2, 7), root, "silver", "t")
    assert first.count() == 400 and read_table(spark, root, "silver", "t").count() == 7


def test_vacuum_keeps_what_readers_may_need(spark, tmp_path):
    root, target = str(tmp_path), table_path(str(tmp_path), "silver", "t")
    for version in range(5):
        write_table(numbers(spark, version, 5), root, "silver", "t")
    assert len(snapshots.commits(spark, target)) == 5  # all are young
    half_written = write_version(numbers(spark, 9, 5), root, "silver", "t")
    assert snapshots.vacuum(spark, target, keep_versions=1, keep_seconds=1000) == 0
    time.sleep(1.1)
    assert snapshots.vacuum(spark, target, keep_versions=1, keep_seconds=0.5) == 3
    left = snapshots.commits(spark, target)
    assert [v.number for v in left] == [5, 4]
    assert sorted(os.listdir(f"{target}/_data")) == sorted(v.id for v in left)
    assert not os.path.exists(half_written.data)
    assert read_table(spark, root, "silver", "t").first()["v"] == 4


def test_tables_are_published_by_one_file(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for name in "ab":
        write_table(numbers(spark, 1), root, "silver", name)
    names = [("silver", "a"), ("silver", "b")]
    new = [write_version(numbers(spark, 2), root, "silver", name) for name in "ab"]
    seen, own = [], snapshots.files.create

    def versions():
        return [df.first()["v"] for df in read_tables(spark, root, names).values()]

    def create(spark, path):
        seen.append(versions())  # what a reader gets just before each step of the publication
        own(spark, path)

    monkeypatch.setattr(snapshots.files, "create", create)
    before = snapshots.published_groups(spark, root)
    publish(spark, new, root)
    assert seen == [[1, 1]] * 3 and versions() == [2, 2]
    # A reader that took its view of the groups before still gets both tables as they were.
    assert [spark.read.parquet(data_path(spark, table_path(root, *n), before)).first()["v"] for n in names] == [1, 1]


def test_a_failed_publication_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for name in "ab":
        write_table(numbers(spark, 1), root, "silver", name)
    new = [write_version(numbers(spark, 2), root, "silver", name) for name in "ab"]
    own = snapshots.files.create

    def create(spark, path):
        if "_groups" in path:
            raise OSError("store is down")
        own(spark, path)

    monkeypatch.setattr(snapshots.files, "create", create)
    with pytest.raises(OSError, match="down"):
        publish(spark, new, root)
    for name in "ab":
        assert read_table(spark, root, "silver", name).first()["v"] == 1
        target = table_path(root, "silver", name)
        assert len(os.listdir(f"{target}/_data")) == 1 and len(snapshots.commits(spark, target)) == 1


def test_old_groups_go_when_no_table_names_them(spark, tmp_path):
    root = str(tmp_path)
    for version in range(3):
        new = [write_version(numbers(spark, version, 3), root, "silver", name) for name in "ab"]
        time.sleep(0.05)
        publish(spark, new, root, keep_versions=0, keep_seconds=0)
    assert len(snapshots.published_groups(spark, root)) <= 2
    assert read_table(spark, root, "silver", "b").first()["v"] == 2


def test_views_move_to_the_new_version(spark, tmp_path):
    root = str(tmp_path)
    write_table(numbers(spark, 1), root, "silver", "t_moved")
    register_views(spark, root, prefix="moved_")
    write_table(spark.range(3).withColumn("other", F.lit("x")), root, "silver", "t_moved")
    assert spark.table("moved_silver.t_moved").columns == ["id", "other"]
    spark.sql("DROP VIEW moved_silver.t_moved")
    write_table(numbers(spark, 3), root, "silver", "t_moved")
    assert not spark.catalog.tableExists("moved_silver.t_moved")


def dump(path, rows):
    with gzip.open(path, "wt") as out:
        out.write("\n".join(["id\tstartYear", *rows]) + "\n")
    return str(path)


def test_one_broken_dump_stops_the_load_and_changes_no_table(spark, tmp_path):
    root, names = str(tmp_path / "lake"), [f"t_{i}" for i in range(5)]
    paths = {n: dump(tmp_path / f"{n}.tsv.gz", [f"{k}\t{1900 + k}" for k in range(20)]) for n in names}
    load_all(spark, paths, root)
    with open(paths["t_3"], "wb") as out:
        out.write(b"\x1f\x8b not a dump")
    with pytest.raises(Exception):  # noqa: B017
        load_all(spark, paths, root, parallelism=5)
    for name, df in read_tables(spark, root, [("bronze", n) for n in names]).items():
        assert df.count() == 20, name
        target = table_path(root, *name)
        assert len(os.listdir(f"{target}/_data")) == 1  # what the others wrote is gone


def test_the_first_failure_cancels_the_other_jobs(spark):
    ended = []

    def slow():
        # Some minutes of work in one task, if nobody stops it.
        spark.range(0, 60_000, 1, 4).select(F.sum(F.expr("aggregate(sequence(1, 200000), 0L, (a, b) -> a + b)"))).collect()
        ended.append("slow")

    def fails():
        time.sleep(1.5)
        raise KeyError("broken")

    started = time.time()
    with pytest.raises(KeyError, match="broken"):
        run_together(spark, {"a": slow, "b": fails, "c": slow, "d": lambda: ended.append("late")}, 3)
    assert time.time() - started < 30 and "slow" not in ended
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()
    assert run_together(spark, {"a": lambda: spark.range(3).count()}, 1) == {"a": 3}


def test_ledger_of_a_load(spark, tmp_path):
    root = str(tmp_path / "lake")
    paths = {"t_a": dump(tmp_path / "a.tsv.gz", ["1\t1999", "2\tabc", "3\tabc", "4\t\\N"]), "t_b": dump(tmp_path / "b.tsv.gz", ["1\t2000"])}
    loaded = load_all(spark, paths, root, ledger="t_bad_cells")
    assert {tuple(r) for r in loaded["t_bad_cells"].collect()} == {("t_a", "startYear", "abc", 2)}
    assert [r["startYear"] for r in loaded["t_a"].orderBy("id").collect()] == [1999, None, None, None]
    with pytest.raises(BadCellsError, match="t_a: 2 bad cells in startYear") as error:
        load_all(spark, paths, root, strict=True, ledger="t_bad_cells")
    assert error.value.counts == {"startYear": 2}
    clean = load_all(spark, {"t_b": paths["t_b"]}, root, strict=True, ledger="t_bad_cells")
    assert clean["t_bad_cells"].count() == 0 and clean["t_bad_cells"].columns == ["table", "column", "raw", "cells"]


@pytest.mark.parametrize("rows", [0, 1, 7, 8, 47, 48, 49, 95, 96, 97, 200, 1000, 4801])
@pytest.mark.parametrize("width", [1, 3, 64])
def test_layouts_keep_their_limits(rows, width):
    plan = plan_layout(rows, 0, width, least_group=8, most_group=16, most_file=48)
    sizes = [rows // plan.files + (i < rows % plan.files) for i in range(plan.files)]
    assert max(sizes) <= 48 and plan.rows_per_group <= 16
    if rows >= 8:
        assert min(sizes) >= 8 and plan.rows_per_group >= 8
    assert plan.files <= max(width, -(-rows // 48), 1)


def test_planned_files_split_a_hot_value_and_keep_the_order(spark, tmp_path):
    rows = spark.range(0, 5_000, 1, 6).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50))
    table, plan = write_planned(
        rows, str(tmp_path), "silver", "t", [F.col("k"), F.col("id")], width=10, least_group=100, most_group=200, most_file=400
    )
    assert plan.files == 13 and table.count() == 5_000 and table.columns == ["id", "k"]
    spans = table.groupBy(F.input_file_name()).agg(F.min(F.struct("k", "id")), F.max(F.struct("k", "id")), F.count("id")).collect()
    spans = sorted((tuple(a), tuple(b), n) for _, a, b, n in spans)
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:])) and {n for *_, n in spans} == {384, 385}
    empty, plan = write_planned(rows.limit(0), str(tmp_path), "silver", "e")
    assert empty.count() == 0 and plan.files == 1
