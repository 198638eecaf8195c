"""Aggregation, reshaping and ranking checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import yes_no
from ..operators.groups import cond_list, sorted_set, string_list
from ..operators.joins import skew_join
from ..operators.rank import cond_rank as ranked_if
from ..operators.rank import dist_row_number
from ..operators.reshape import unpivot_lists
from .registry import check, table


@check("""
    SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN 'Y' ELSE 'N' END) AS buys,
           max(CASE WHEN value > 60 THEN 'Y' ELSE 'N' END) AS big FROM events GROUP BY user_id""")
def flag_any(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy("user_id")
        .agg(
            F.max(yes_no(F.col("event_type") == "purchase")).alias("buys"),
            F.max(yes_no(F.col("value") > 60)).alias("big"),
        )
    )


@check("""
    SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS priorities
    FROM orders GROUP BY o_custkey""")
def string_list_distinct(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return string_list(orders, ["o_custkey"], F.col("o_orderpriority"), "priorities", "; ", distinct=True)


@check("""
    SELECT l_orderkey, string_agg(s_name, '; ' ORDER BY s_name) FILTER (l_returnflag = 'R') AS returned,
           string_agg(s_name, '; ' ORDER BY s_name) FILTER (l_returnflag = 'A') AS accepted,
           string_agg(s_name, '; ' ORDER BY s_name) FILTER (l_linestatus = 'O' AND l_quantity > 40) AS open
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey""")
def cond_string_list(spark: SparkSession, sf: str) -> DataFrame:
    lines, supplier = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    names = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    named = skew_join(lines, names, ["l_suppkey"])
    flag = F.col("l_returnflag")
    tests = {
        "returned": flag == "R",
        "accepted": flag == "A",
        "open": (F.col("l_linestatus") == "O") & (F.col("l_quantity") > 40),
    }
    return cond_list(named, ["l_orderkey"], F.col("s_name"), tests)


@check("""
    SELECT l_suppkey, string_agg(l_returnflag, ', ' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY l_suppkey""")
def string_list_all(spark: SparkSession, sf: str) -> DataFrame:
    return string_list(table(spark, sf, "lineitem"), ["l_suppkey"], F.col("l_returnflag"), "flags", ", ")


@check("""
    SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, coalesce(nullif(o_orderstatus, 'P'), 'N') AS status,
           count(*) AS n_orders, CAST(max(o_custkey) AS BIGINT) AS last_cust
    FROM orders GROUP BY 1, 2""")
def group_by_expr(spark: SparkSession, sf: str) -> DataFrame:
    status = F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit("N"))
    return (
        table(spark, sf, "orders")
        .groupBy(F.year("o_orderdate").cast("bigint").alias("order_year"), status.alias("status"))
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_custkey").alias("last_cust"))
    )


@check("""
    SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty
    FROM lineitem GROUP BY ALL""")
def group_by_all(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty
           FROM {lines} GROUP BY ALL""",
        lines=table(spark, sf, "lineitem"),
    )


@check("SELECT DISTINCT p_brand, p_type, p_size FROM part")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_brand", "p_type", "p_size").distinct()


@check("""
    SELECT user_id, CAST(len(kinds) AS BIGINT) AS n_kinds, array_to_string(kinds, '|') AS kinds
    FROM (SELECT user_id, list_sort(list(DISTINCT event_type)) AS kinds FROM events GROUP BY user_id)""")
def distinct_list(spark: SparkSession, sf: str) -> DataFrame:
    kinds = table(spark, sf, "events").groupBy("user_id").agg(sorted_set(F.col("event_type")).alias("kinds"))
    return kinds.select("user_id", F.size("kinds").cast("bigint").alias("n_kinds"), F.array_join("kinds", "|").alias("kinds"))


@check("""
    SELECT l_orderkey, l_linenumber, 'discount' AS measure, l_discount AS amount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem""")
def unpivot_measures(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax")
    )
    return lines.unpivot(["l_orderkey", "l_linenumber"], ["discount", "tax"], "measure", "amount")


@check("""
    SELECT p_partkey, 'words' AS kind, unnest(string_split(p_name, ' ')) AS item FROM part
    UNION ALL SELECT p_partkey, 'types', unnest(string_split(p_type, ' ')) FROM part WHERE p_size > 10""", "unpivot_lists")
def unpivot_lists_of_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_size") > 10, F.col("p_type")).alias("p_type")
    )
    return unpivot_lists(parts, "p_partkey", {"words": "p_name", "types": "p_type"}, "kind", "item", " ")


@check("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
           row_number() OVER (ORDER BY chosen ASC NULLS LAST, l_extendedprice DESC NULLS LAST,
                              l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_num
    FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN l_discount END AS chosen FROM lineitem)""")
def global_row_number(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    chosen = F.when(F.col("l_returnflag") == "R", F.col("l_discount"))
    lines = table(spark, sf, "lineitem").select(*keys, "l_extendedprice", chosen.alias("chosen"))
    order = [F.col("chosen").asc_nulls_last(), F.col("l_extendedprice").desc_nulls_last(), *[F.col(k).asc() for k in keys]]
    return dist_row_number(lines, order, "row_num").drop("chosen")


@check("""
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN row_number() OVER (
               ORDER BY CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END,
                        o_totalprice DESC NULLS LAST, o_orderkey)
           ELSE 9999 END AS rnk
    FROM orders""")
def cond_rank(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    order = [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()]
    return ranked_if(orders, F.col("o_orderpriority") == "1-URGENT", order, "rnk").select("o_orderkey", "rnk")


@check("""
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN row_number() OVER (
               ORDER BY CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey ELSE 50 END,
                        o_orderpriority = '1-URGENT' DESC, o_orderkey)
           ELSE 9999 END AS rnk
    FROM orders""")
def cond_rank_behind(spark: SparkSession, sf: str) -> DataFrame:
    """Urgent orders of customers above 50 rank behind all orders that are not urgent."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    order = [F.col("o_custkey").asc(), F.col("o_orderkey").asc()]
    urgent = F.col("o_orderpriority") == "1-URGENT"
    ranked = ranked_if(orders, urgent, order, "rnk", behind=F.col("o_custkey") > 50)
    return ranked.select("o_orderkey", "rnk")


@check("""
    SELECT doc_id, row_number() OVER (ORDER BY quality ASC NULLS LAST, toxic DESC NULLS LAST, n_chars DESC, doc_id) AS pos
    FROM documents LEFT JOIN labels USING (doc_id)""")
def sort_nulls(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "n_chars")
    order = [
        F.col("quality").asc_nulls_last(),
        F.col("toxic").desc_nulls_last(),
        F.col("n_chars").desc_nulls_last(),
        F.col("doc_id").asc(),
    ]
    labelled = documents.join(table(spark, sf, "labels"), "doc_id", "left")
    return dist_row_number(labelled, order, "pos").select("doc_id", "pos")
