"""Joins with one key in a third of the rows equal plain joins and stay spread."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marquetry.operators import joins
from marquetry.operators.groups import cond_list, string_list
from marquetry.operators.resolve import resolve_entities


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share key 7, another tenth has no key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(30_000).withColumn("k", key.cast("bigint")).withColumn("same", F.lit("x"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(0, 450).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_equals_plain(facts, dim, how):
    assert bag(joins.skew_join(facts, dim, ["k"], how)) == bag(facts.join(dim, ["k"], how))


def test_two_keys_and_copies(spark, dim):
    rows = spark.range(4000).select(F.lit(7).cast("bigint").alias("k"), F.lit("n7").alias("name"))
    rows = rows.union(dim)
    right = dim.withColumn("v", F.col("k") * 2)
    got = joins.skew_join(rows, right, ["k", "name"])
    assert bag(got) == bag(rows.join(right, ["k", "name"]))


def test_hot_keys_are_few_and_found(facts):
    key = joins.key_hash(facts, ["k"], facts)
    names = {h: k for k, h in facts.select("k", key.alias("h")).distinct().collect()}
    hot = {names[h]: salts for h, salts in joins.hot_keys(facts, key).items()}
    assert set(hot) <= {7, None} and hot[7] >= 3
    assert len(hot) < joins.shuffle_width(facts)


def test_every_key_above_the_share_is_found(spark):
    """Some keys just above an average partition, among many times more keys than a sketch tracks."""
    width = joins.shuffle_width(spark.range(1))
    rows, above = 200_000, width - 2
    key = F.when(F.col("id") % width < above, F.col("id") % width).otherwise(F.col("id") + 1_000)
    df = spark.range(0, rows, 1, 13).select(key.alias("k"))
    extra = spark.range(0, above).select(F.explode(F.array_repeat("id", 50)).alias("k"))
    df = df.union(extra)
    hashed = joins.key_hash(df, ["k"], df)
    counts = {r["h"]: r["count"] for r in df.groupBy(hashed.alias("h")).count().collect()}
    hot, total = joins.hot_keys(df, hashed), df.count()
    assert {h for h, n in counts.items() if n * width > total} <= set(hot)
    assert all(hot[h] >= -(-counts[h] * width // total) for h in hot) and len(hot) < 2 * width


def test_keys_of_other_width_hash_alike(spark, facts):
    narrow = spark.range(0, 450).select(F.col("id").cast("int").alias("k"), F.lit("n").alias("name"))
    assert bag(joins.skew_join(facts, narrow, ["k"])) == bag(facts.join(narrow, ["k"]))


def test_no_hot_key_no_salt(spark, dim):
    flat = spark.range(0, 10_000).select((F.col("id") % 450).alias("k"))
    plan = joins.skew_join(flat, dim, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan
    assert joins.hot_keys(flat.limit(0), F.col("k")) == {}


def test_hot_rows_are_spread(spark, facts, dim):
    """No shuffle partition gets the hot key whole."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = joins.skew_join(facts.repartition(8), dim, ["k"])
        sizes = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) >= 2 and max(r["count"] for r in sizes) < 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_copies_of_one_row_are_spread(spark, dim):
    copies = spark.range(0, 8000, 1, 8).select(F.lit(7).cast("bigint").alias("k"), F.lit("x").alias("t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = joins.skew_join(copies, dim, ["k"])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 8000 and len(sizes) >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", True)


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_derived_left_is_read_once(facts, dim, how):
    derived = facts.union(facts).distinct()
    assert bag(joins.skew_join(derived, dim, ["k"], how, derived=True)) == bag(derived.join(dim, ["k"], how))


def test_left_join_with_filter_in_on(facts, dim):
    got = joins.filtered_left_join(dim, facts, ["k"], F.col("id") > 15_000)
    expected = dim.join(facts.filter("id > 15000"), ["k"], "left")
    assert bag(got.select("k", "name", "id")) == bag(expected.select("k", "name", "id"))
    assert got.select("k").distinct().count() == 450


def test_anti_join_keeps_null_keys(facts, dim):
    got = joins.anti_join(facts, dim.union(dim), ["k"])
    assert bag(got) == bag(facts.join(dim, ["k"], "left_anti"))
    assert got.filter("k IS NULL").count() > 0


def test_lists_of_a_hot_group(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") != 3, F.concat(F.lit("v"), F.col("id") % 4)).alias("v"),
    )
    got = string_list(df, ["k"], F.col("v"), "vs", ",").filter("k = 0").first()["vs"].split(",")
    assert len(got) == 2999 and got == sorted(got) and set(got) == {"v0", "v1", "v2", "v3"}
    once = string_list(df, ["k"], F.col("v"), "vs", ",", distinct=True).filter("k = 0").first()
    assert once["vs"] == "v0,v1,v2,v3"


def test_list_without_values_is_null_and_group_stays(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "y", 2), ("b", "", 1)], "k string, v string, n int")
    got = cond_list(df, ["k"], F.col("v"), {"one": F.col("n") == 1, "two": F.col("n") == 2, "none": F.col("n") == 3})
    assert {r["k"]: (r["one"], r["two"], r["none"]) for r in got.collect()} == {
        "a": ("x", None, None),
        "b": ("", "y", None),
    }


def test_distinct_list_per_condition(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 3), ("a", "w", 1), ("a", "x", 1)], "k string, v string, n int")
    tests = {"odd": F.col("n") % 2 == 1, "one": F.col("n") == 1}
    got = cond_list(df, ["k"], F.col("v"), tests, ",", distinct=True).first()
    assert (got["odd"], got["one"]) == ("w,x", "w,x")
    got = cond_list(df, ["k"], F.col("v"), tests, ",").first()
    assert (got["odd"], got["one"]) == ("w,x,x,x", "w,x,x")


def test_resolution_of_a_hot_name_builds_no_pairs(spark):
    """3,000 name rows and 2,000 entities with one name: every pair would be 6 million rows."""
    names = spark.range(3000).select(F.lit("n").alias("name"), F.lit(1).alias("year"), F.col("id").alias("v"))
    entities = spark.range(2000).select(
        F.col("id").alias("e"), F.lit("n").alias("name"), F.lit(1).alias("year"), (F.col("id") % 50).alias("w")
    )
    ids = spark.createDataFrame([(49, "n", 1, 2999)], "e bigint, name string, year int, v bigint")
    got = resolve_entities(ids, names, entities, "e", ["name", "year"], "v", F.col("w")).collect()
    # Entity 49 has an id row, so 99 is the first of weight 49; 2999 is a copy of the id row.
    assert [(r["e"], r["v"]) for r in got] == [(99, 2998)]
