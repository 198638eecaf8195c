"""Projection, filter and scalar checks."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import money, non_empty, title_id, yes_no
from ..operators.groups import cond_max
from ..operators.joins import skew_join
from ..operators.rank import top1_per_group
from ..operators.reshape import explode_list, flag_columns as flags
from ..plans.top_title import flag_lists, places_before
from .analogues import LIST_ROWS, frame, inline
from .registry import check, table


@check("""
    SELECT o_orderkey AS id, o_orderpriority AS kind, o_totalprice AS price,
           CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS is_final
    FROM orders""")
def title_select(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("kind"),
        F.col("o_totalprice").alias("price"),
        yes_no(F.col("o_orderstatus") == "F").alias("is_final"),
    )


@check("""
    SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS o_custkey,
           CAST(o_custkey + 1 AS BIGINT) AS next_cust
    FROM orders""")
def parallel_columns(spark: SparkSession, sf: str) -> DataFrame:
    # next_cust is computed from the column that is replaced beside it.
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", "o_custkey", "o_totalprice")
        .withColumns(
            {
                "o_custkey": F.when(F.col("o_totalprice") > 250000, 1).otherwise(0),
                "next_cust": F.col("o_custkey") + 1,
            }
        )
        .drop("o_totalprice")
    )


@check(f"""
    SELECT tconst, rnk, CASE WHEN regexp_matches(type, '^top') OR contains(type, 'top_1000')
           THEN 'Y' ELSE 'N' END AS is_top_title
    FROM (SELECT tconst, type, rnk + CASE WHEN contains(type, 'moviemeter=')
                 THEN coalesce(try_cast(regexp_extract(type, 'moviemeter=([0-9]+),', 1) AS BIGINT), 1) - 1
                 ELSE 0 END AS rnk FROM {inline(LIST_ROWS)})""")
def top_flags(spark: SparkSession, sf: str) -> DataFrame:
    return flag_lists(frame(spark, sf, LIST_ROWS)).select("tconst", "rnk", "is_top_title")


@check("""
    SELECT o_orderkey, o_totalprice * 2 AS twice, o_totalprice * 2 + 1 AS more,
           CASE WHEN o_totalprice * 2 > 500000 THEN 'Y' ELSE 'N' END AS is_big
    FROM orders""")
def lateral_alias(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "o_totalprice * 2 AS twice",
        "twice + 1 AS more",
        "CASE WHEN twice > 500000 THEN 'Y' ELSE 'N' END AS is_big",
    )


@check("SELECT * EXCLUDE (o_orderdate, o_orderpriority) FROM orders")
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").drop("o_orderdate", "o_orderpriority")


@check("""
    SELECT event_id, CASE WHEN event_type = 'click' THEN 'Y' ELSE 'N' END AS is_click,
           CASE WHEN value > 10 THEN 'Y' ELSE 'N' END AS is_large,
           CASE WHEN event_type LIKE '%e%' AND value > 5 THEN 'Y' ELSE 'N' END AS is_mixed
    FROM events""")
def flag_columns(spark: SparkSession, sf: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    tests = {"is_click": kind == "click", "is_large": value > 10, "is_mixed": kind.like("%e%") & (value > 5)}
    return table(spark, sf, "events").select("event_id", *flags(tests))


@check("""
    SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL""")
def filter_not_null(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return (
        documents.join(labels, "doc_id", "left").filter(F.col("quality").isNotNull()).select("doc_id", "quality")
    )


@check("""
    SELECT 'named' AS part, o_orderkey FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'
    UNION ALL SELECT 'unnamed', o_orderkey FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'""")
def sentinel_split(spark: SparkSession, sf: str) -> DataFrame:
    orders, unnamed = table(spark, sf, "orders"), F.col("o_orderpriority") == "4-NOT SPECIFIED"
    return (
        orders.filter(~unnamed)
        .select(F.lit("named").alias("part"), "o_orderkey")
        .union(orders.filter(unnamed).select(F.lit("unnamed"), "o_orderkey"))
    )


@check("SELECT p_partkey, p_type FROM part WHERE p_type IN ('PROMO', 'SMALL')")
def filter_in(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").filter(F.col("p_type").isin("PROMO", "SMALL")).select("p_partkey", "p_type")


@check("""
    SELECT p_partkey, kind FROM (SELECT p_partkey, nullif(p_type, 'LARGE') AS kind FROM part)
    WHERE kind NOT IN ('PROMO', 'SMALL')""")
def filter_not_in(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.nullif(F.col("p_type"), F.lit("LARGE")).alias("kind")
    parts = table(spark, sf, "part").select("p_partkey", kind)
    return parts.filter(~F.col("kind").isin("PROMO", "SMALL"))


@check("""
    SELECT page_id, CASE WHEN url LIKE '%/en/%' THEN 'Y' ELSE 'N' END AS is_en,
           CASE WHEN url LIKE 'http___%' THEN 'Y' ELSE 'N' END AS any_four,
           CASE WHEN url LIKE '%utm_source%' THEN 'Y' ELSE 'N' END AS tracked
    FROM pages""")
def like_flags(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    tests = {"is_en": url.like("%/en/%"), "any_four": url.like("http___%"), "tracked": url.like("%utm_source%")}
    return table(spark, sf, "pages").select("page_id", *flags(tests))


@check("""
    SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]{3}-[0-9]{4}') THEN 'Y' ELSE 'N' END AS has_number,
           CASE WHEN contains(text, ' the ') THEN 'Y' ELSE 'N' END AS has_word
    FROM documents""")
def regex_contains(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    tests = {"has_number": text.rlike("[0-9]{3}-[0-9]{4}"), "has_word": text.contains(" the ")}
    return table(spark, sf, "documents").select("doc_id", *flags(tests))


@check("""
    SELECT l_partkey, l_returnflag, l_extendedprice, l_quantity, l_orderkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey, l_returnflag
        ORDER BY l_extendedprice DESC NULLS LAST, l_quantity DESC NULLS LAST, l_orderkey) = 1""", "top1_per_group")
def top1_per_group_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    order = [
        F.col("l_extendedprice").desc_nulls_last(),
        F.col("l_quantity").desc_nulls_last(),
        F.col("l_orderkey").asc(),
    ]
    lines = table(spark, sf, "lineitem").select(
        "l_partkey", "l_returnflag", "l_extendedprice", "l_quantity", "l_orderkey"
    )
    return top1_per_group(lines, ["l_partkey", "l_returnflag"], order)


@check("""
    SELECT user_id, max(value) FILTER (event_type = 'click') AS click,
           max(value) FILTER (event_type = 'view') AS view,
           max(value) FILTER (event_type = 'error') AS error,
           max(value) FILTER (event_type = 'purchase' AND value < 50) AS small_purchase
    FROM events GROUP BY user_id""")
def cond_max_pivot(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    tests = {name: kind == name for name in ("click", "view", "error")}
    tests["small_purchase"] = (kind == "purchase") & (F.col("value") < 50)
    return table(spark, sf, "events").groupBy("user_id").agg(*cond_max(tests, F.col("value")))


@check("""
    WITH dim AS (SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang)
    SELECT page_id, n_docs FROM pages LEFT JOIN dim ON dim.lang =
        CASE WHEN url LIKE '%/en/%' THEN 'en' WHEN url LIKE '%/fr/%' THEN 'fr' WHEN url LIKE '%/de/%' THEN 'de' END""")
def case_key_join(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))
    url = F.col("url")
    key = F.when(url.like("%/en/%"), "en").when(url.like("%/fr/%"), "fr").when(url.like("%/de/%"), "de")
    keyed = table(spark, sf, "pages").select("page_id", key.alias("lang"))
    return skew_join(keyed, dim, ["lang"], "left").select("page_id", "n_docs")


@check("""
    SELECT doc_id, coalesce(quality, 9999) AS quality,
           coalesce(CASE WHEN toxic = 1 THEN 'Y' WHEN toxic = 0 THEN 'N' END, '-') AS toxic
    FROM documents LEFT JOIN labels USING (doc_id)""")
def coalesce_defaults(spark: SparkSession, sf: str) -> DataFrame:
    toxic = F.when(F.col("toxic") == 1, "Y").when(F.col("toxic") == 0, "N")
    return (
        table(spark, sf, "documents")
        .join(table(spark, sf, "labels"), "doc_id", "left")
        .select(
            "doc_id",
            F.coalesce("quality", F.lit(9999)).alias("quality"),
            F.coalesce(toxic, F.lit("-")).alias("toxic"),
        )
    )


@check("SELECT page_id, try_cast(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS number FROM pages")
def regex_cast(spark: SparkSession, sf: str) -> DataFrame:
    number = F.regexp_extract("url", "/([0-9]+)", 1).try_cast("bigint")
    return table(spark, sf, "pages").select("page_id", number.alias("number"))


@check("""
    SELECT page_id, regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2) AS number,
           nullif(regexp_extract(url, '(tt[0-9]+)', 1), '') AS title_id,
           nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS page
    FROM pages""")
def regex_group(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract("url", "/([a-z]{2})/([0-9]+)", 2).alias("number"),
        title_id(F.col("url")).alias("title_id"),
        non_empty(F.regexp_extract("url", "[?&]page=([0-9]+)", 1)).alias("page"),
    )


@check("SELECT p_partkey, regexp_replace(p_name, '[gt]$', '') AS stem FROM part")
def regex_replace(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.regexp_replace("p_name", "[gt]$", "").alias("stem"))


@check("SELECT p_partkey, p_size, unnest(string_split(p_name, ' ')) AS word FROM part")
def split_explode(spark: SparkSession, sf: str) -> DataFrame:
    return explode_list(table(spark, sf, "part").select("p_partkey", "p_size", "p_name"), "p_name", "word", " ")


@check("""
    SELECT doc_id, CASE WHEN lang <> 'en' THEN source || ' (' || lang || ')' END AS label FROM documents""")
def concat_null(spark: SparkSession, sf: str) -> DataFrame:
    lang = F.nullif(F.col("lang"), F.lit("en"))
    label = F.concat("source", F.lit(" ("), lang, F.lit(")"))
    return table(spark, sf, "documents").select("doc_id", label.alias("label"))


@check(f"""
    SELECT tconst, type, rnk + CASE WHEN type LIKE '?release_date=,9999%'
           THEN CAST(split_part(split_part(type, 'moviemeter=', 2), ',', 1) AS BIGINT) - 1 ELSE 0 END AS rnk
    FROM {inline(LIST_ROWS)}""")
def rank_offset(spark: SparkSession, sf: str) -> DataFrame:
    rank = F.col("rnk") + places_before(F.col("type"))
    return frame(spark, sf, LIST_ROWS).select("tconst", "type", rank.alias("rnk"))


@check("SELECT o_orderkey, '2024-05-17' AS last_refresh_date FROM orders")
def run_date_column(spark: SparkSession, sf: str) -> DataFrame:
    day = F.lit(datetime.date(2024, 5, 17)).cast("string")
    return table(spark, sf, "orders").select("o_orderkey", day.alias("last_refresh_date"))


@check("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           coalesce(json_extract_string(props, '$.absent.id'), 'NA') AS absent
    FROM events""")
def json_extract(spark: SparkSession, sf: str) -> DataFrame:
    data = F.from_json("props", "k bigint, absent struct<id:string>")
    return (
        table(spark, sf, "events")
        .select("event_id", data.alias("d"))
        .select("event_id", "d.k", F.coalesce("d.absent.id", F.lit("NA")).alias("absent"))
    )


@check("SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS gross FROM orders")
def money_parse(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("$"), F.format_number(F.floor("o_totalprice"), 0))
    return table(spark, sf, "orders").select("o_orderkey", money(text).alias("gross"))
