"""Join and set-operation checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import anti_join, filtered_left_join, skew_join
from ..operators.reshape import explode_list
from ..operators.resolve import resolve_entities
from ..plans.gold import TITLE_TYPES
from ..plans.gold import gold_star as star
from ..plans.top_title import CHARTS
from ..sources.scratch import stage
from .analogues import BASICS, GROSS_ROWS, PRINCIPALS, RATINGS, frame, inline
from .registry import check, table


@check("SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)")
def left_join_documents_labels(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, sf, "labels"), "doc_id", "left")


@check("""
    SELECT p.p_partkey, q.top_price FROM part p
    JOIN (SELECT p_name, p_size, p_type, max(p_retailprice) AS top_price FROM part GROUP BY ALL) q
      ON p.p_name = q.p_name AND p.p_size = q.p_size AND q.p_type = 'PROMO'""")
def inner_multi_key(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    tops = part.groupBy("p_name", "p_size", "p_type").agg(F.max("p_retailprice").alias("top_price"))
    promo = tops.filter("p_type = 'PROMO'").drop("p_type")
    return skew_join(part, promo, ["p_name", "p_size"]).select("p_partkey", "top_price")


@check("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_one_key(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "source")
    return anti_join(documents, table(spark, sf, "labels"), ["doc_id"])


@check("""
    SELECT l_partkey, l_returnflag, l_linenumber, l_extendedprice FROM lineitem a WHERE l_linestatus = 'O'
    AND NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_linestatus = 'F' AND b.l_partkey = a.l_partkey
                    AND b.l_returnflag = a.l_returnflag AND b.l_linenumber = a.l_linenumber)""")
def anti_three_keys(spark: SparkSession, sf: str) -> DataFrame:
    on = ["l_partkey", "l_returnflag", "l_linenumber"]
    lines = table(spark, sf, "lineitem")
    open_lines = lines.filter("l_linestatus = 'O'").select(*on, "l_extendedprice")
    return anti_join(open_lines, lines.filter("l_linestatus = 'F'"), on)


@check("""
    SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (
        SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')""")
def not_exists(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """SELECT c_custkey, c_name FROM {customer} c WHERE NOT EXISTS (
            SELECT 1 FROM (SELECT DISTINCT o_custkey FROM {orders} WHERE o_orderstatus = 'F') o
            WHERE o.o_custkey = c.c_custkey)""",
        customer=table(spark, sf, "customer"),
        orders=table(spark, sf, "orders"),
    )


# A third of the line items on one key, another tenth on none.
_HOT = """CASE WHEN l_linenumber % 3 = 0 THEN 7 WHEN l_quantity = 10 THEN NULL ELSE l_suppkey END"""


def hot_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_HOT).alias("s_suppkey"))


@check(f"""
    SELECT l_orderkey, l_linenumber, l.s_suppkey, s_name FROM (SELECT *, {_HOT} AS s_suppkey FROM lineitem) l
    JOIN supplier s ON s.s_suppkey = l.s_suppkey""")
def hot_key_inner(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return skew_join(hot_lines(spark, sf), names, ["s_suppkey"])


@check(f"""
    SELECT l_orderkey, l_linenumber, l.s_suppkey, s_name FROM (SELECT *, {_HOT} AS s_suppkey FROM lineitem) l
    LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey < 12) s ON s.s_suppkey = l.s_suppkey""")
def hot_key_left(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "supplier").filter("s_nationkey < 12").select("s_suppkey", "s_name")
    return skew_join(hot_lines(spark, sf), names, ["s_suppkey"], "left")


@check(f"""
    SELECT l_orderkey, l_linenumber, s_suppkey FROM (SELECT *, {_HOT} AS s_suppkey FROM lineitem) l
    WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.s_suppkey AND s_nationkey < 12)""")
def hot_key_anti(spark: SparkSession, sf: str) -> DataFrame:
    return anti_join(hot_lines(spark, sf), table(spark, sf, "supplier").filter("s_nationkey < 12"), ["s_suppkey"])


@check("""
    SELECT l_orderkey, l_returnflag, s_name, n_name FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def crew_inner(spark: SparkSession, sf: str) -> DataFrame:
    credits = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", F.col("l_suppkey").alias("s_suppkey"))
    people = table(spark, sf, "supplier").join(
        table(spark, sf, "nation").withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey"
    )
    return skew_join(credits, people.select("s_suppkey", "s_name", "n_name"), ["s_suppkey"]).select(
        "l_orderkey", "l_returnflag", "s_name", "n_name"
    )


@check("""
    WITH words AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part),
         dim AS (SELECT word, min(p_partkey) AS first_part FROM words WHERE word <> 'bolt' GROUP BY word)
    SELECT p_partkey, words.word, first_part FROM words LEFT JOIN dim USING (word)""")
def explode_lookup(spark: SparkSession, sf: str) -> DataFrame:
    words = explode_list(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "word", " ")
    dim = words.filter("word <> 'bolt'").groupBy("word").agg(F.min("p_partkey").alias("first_part"))
    return skew_join(words, dim, ["word"], "left")


@check(f"""
    WITH t AS (SELECT b.tconst, titleType AS title_type, numVotes AS num_votes
               FROM {inline(BASICS)} b LEFT JOIN {inline(RATINGS)} r ON b.tconst = r.tconst),
         c AS (SELECT tconst, string_agg(nconst, '; ' ORDER BY nconst) FILTER (category = 'director') AS director_lst,
                      string_agg(nconst, '; ' ORDER BY nconst) FILTER (category = 'actor') AS actor_lst,
                      string_agg(nconst, '; ' ORDER BY nconst) FILTER (category = 'actress') AS actress_lst
               FROM {inline(PRINCIPALS)} GROUP BY tconst),
         g AS (SELECT tconst, max(box_office) AS box_office FROM {inline(GROSS_ROWS)} GROUP BY tconst)
    SELECT t.tconst, title_type, num_votes, director_lst, actor_lst, actress_lst, box_office,
           CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE 9999 END AS top_250_movie_rnk,
           CAST(9999 AS BIGINT) AS top_250_tv_rnk, 'N' AS is_top_1000_movie,
           CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS is_top_title
    FROM t LEFT JOIN c USING (tconst) LEFT JOIN g USING (tconst) JOIN orders ON 'tt' || o_orderkey = t.tconst
    WHERE title_type IN ({", ".join(repr(t) for t in TITLE_TYPES)})""")
def gold_star(spark: SparkSession, sf: str) -> DataFrame:
    ratings = frame(spark, sf, RATINGS).select("tconst", F.col("numVotes").alias("num_votes"))
    title = frame(spark, sf, BASICS).select("tconst", F.col("titleType").alias("title_type"))
    crew = frame(spark, sf, PRINCIPALS).select("tconst", "category", F.col("nconst").alias("name"))
    listed = F.col("o_orderstatus") == "F"
    top = table(spark, sf, "orders").select(
        F.concat(F.lit("tt"), "o_orderkey").alias("tconst"),
        F.when(listed, F.col("o_custkey")).alias("top_250_movie_rnk"),
        *[F.lit(None).cast("bigint").alias(chart) for chart in CHARTS if chart != "top_250_movie_rnk"],
        F.lit(None).cast("string").alias("is_top_1000_movie"),
        F.when(listed, "Y").alias("is_top_title"),
    )
    joined = star(
        title.join(ratings, "tconst", "left"),
        crew,
        top,
        frame(spark, sf, GROSS_ROWS).select("tconst", "box_office"),
    )
    return joined.select(
        "tconst", "title_type", "num_votes", "director_lst", "actor_lst", "actress_lst", "box_office",
        "top_250_movie_rnk", "top_250_tv_rnk", "is_top_1000_movie", "is_top_title",
    )


@check("""
    SELECT o_orderkey, l_linenumber, l_quantity FROM orders
    LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag IN ('R') AND l_quantity > 25""")
def left_join_on_predicate(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    wanted = F.col("l_returnflag").isin("R") & (F.col("l_quantity") > 25)
    orders = table(spark, sf, "orders").select("o_orderkey")
    return filtered_left_join(orders, lines, ["o_orderkey"], wanted).select(
        "o_orderkey", "l_linenumber", "l_quantity"
    )


@check("""
    WITH sales AS (SELECT p_partkey, p_name, p_size, p_brand, l_linestatus, CAST(floor(l_extendedprice) AS BIGINT) AS v
                   FROM lineitem JOIN part ON l_partkey = p_partkey),
         ids AS (SELECT p_partkey, p_name, p_size, v FROM sales WHERE p_brand < 'Brand#2'),
         pairs AS (SELECT e.p_partkey, n.p_name, n.p_size, n.v, e.p_retailprice
                   FROM sales n JOIN part e ON e.p_name = n.p_name AND e.p_size = n.p_size
                   WHERE n.l_linestatus = 'F'
                     AND e.p_partkey NOT IN (SELECT p_partkey FROM ids)
                     AND (n.p_name, n.p_size, n.v) NOT IN (SELECT (p_name, p_size, v) FROM ids))
    SELECT p_partkey, v FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_size
        ORDER BY p_retailprice DESC NULLS LAST, v DESC NULLS LAST, p_partkey) AS rn FROM pairs) WHERE rn = 1""")
def entity_resolve(spark: SparkSession, sf: str) -> DataFrame:
    part, lines = table(spark, sf, "part"), table(spark, sf, "lineitem")
    sold = skew_join(lines.withColumnRenamed("l_partkey", "p_partkey"), part, ["p_partkey"]).select(
        "p_partkey", "p_name", "p_size", "p_brand", "l_linestatus", F.floor("l_extendedprice").cast("bigint").alias("v")
    )
    # Read three times below, so written once.
    sales = stage(sold, "sales")
    return resolve_entities(
        sales.filter("p_brand < 'Brand#2'"),
        sales.filter("l_linestatus = 'F'"),
        part,
        key="p_partkey",
        on=["p_name", "p_size"],
        value="v",
        prefer=F.col("p_retailprice"),
    )


@check("SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    return customers.union(table(spark, sf, "supplier").select("s_nationkey", "s_acctbal"))


@check("""
    SELECT c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL BY NAME SELECT s_acctbal AS balance, s_name AS name FROM supplier""")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers)


@check("SELECT o_custkey AS cust, o_orderstatus AS flag FROM orders UNION SELECT l_suppkey, l_linestatus FROM lineitem")
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("flag"))
    return orders.union(table(spark, sf, "lineitem").select("l_suppkey", "l_linestatus")).distinct()
