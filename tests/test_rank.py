"""Global numbering equals a plain window, whatever the data and partitioning."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from marquetry.operators.rank import cond_rank, dist_row_number, top1_per_group

ROWS = st.lists(
    st.tuples(st.none() | st.integers(-3, 3), st.none() | st.sampled_from(["a", "b", ""])), max_size=40
)


def keys():
    return [F.col("x").asc_nulls_last(), F.col("y").desc_nulls_last(), F.col("id").asc()]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS)
def test_equals_plain_window(spark, rows):
    df = spark.createDataFrame(
        [(i, x, y) for i, (x, y) in enumerate(rows)], "id bigint, x bigint, y string"
    ).repartition(3)
    plain = df.withColumn("n", F.row_number().over(Window.orderBy(*keys())).cast("bigint"))
    got = dist_row_number(df, keys(), "n")
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("width", [1, 4, 32])
def test_one_value_in_nearly_all_rows(spark, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        df = spark.range(20_000).withColumn("x", F.when(F.col("id") % 100 == 0, F.col("id")))
        order = [F.col("x").asc_nulls_last(), F.col("id").desc()]
        ranked = dist_row_number(df, order, "n")
        found = ranked.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
        assert tuple(found) == (1, 20_000, 20_000)
        assert ranked.filter("id = 0").first()["n"] == 1
        assert ranked.filter("id = 19999").first()["n"] == 201
        assert ranked.filter("id = 1").first()["n"] == 20_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_number_of_parts_is_a_parameter(spark):
    ranked = dist_row_number(spark.range(5000), [F.col("id").desc()], "n", n_parts=3)
    assert ranked.filter(F.col("n") != 5000 - F.col("id")).count() == 0


def test_empty_input(spark):
    assert dist_row_number(spark.range(0), [F.col("id").asc()], "n").count() == 0


def test_numbering_uses_every_partition(spark):
    df = spark.range(200_000).withColumn("x", F.lit(None).cast("bigint"))
    order = [F.col("x").asc_nulls_last(), F.col("id").asc()]
    sizes = df.repartitionByRange(8, *order).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * 200_000 / 8


def test_cond_rank(spark):
    df = spark.createDataFrame([("a", 3, True), ("b", 5, True), ("c", 9, None), ("d", 9, False)], "k string, v int, f boolean")
    got = cond_rank(df, F.col("f"), [F.col("v").desc(), F.col("k").asc()], "r")
    assert {r["k"]: r["r"] for r in got.collect()} == {"b": 1, "a": 2, "c": 9999, "d": 9999}


def test_top1_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    top = top1_per_group(df, ["k"], [F.col("id").desc()])
    assert {r["k"]: r["id"] for r in top.collect()} == {0: 999, 1: 997, 2: 998}
    plan = top._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert plan.index("WindowGroupLimit", shuffle) > shuffle
