"""Catalogue-shaped inputs derived from the test tables.

Orders play titles, line items credits and list rows, suppliers people. Each
mapping is one SELECT that Spark and the oracle both run; what is computed from
these inputs is written separately for each side.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import skew_join
from .registry import table

BASICS = """
SELECT 'tt' || CAST(o_orderkey AS STRING) AS tconst,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'movie' WHEN '2-HIGH' THEN 'tvSeries'
            WHEN '3-MEDIUM' THEN 'short' WHEN '5-LOW' THEN 'tvSpecial' ELSE 'tvEpisode' END AS titleType,
       'Order ' || CAST(o_custkey AS STRING) AS primaryTitle,
       o_orderstatus || ' ' || o_orderpriority AS originalTitle,
       CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS isAdult,
       CAST(year(o_orderdate) AS BIGINT) AS startYear,
       CAST(o_custkey % 180 AS BIGINT) AS runtimeMinutes,
       o_orderpriority AS genres
FROM {orders}"""

RATINGS = """
SELECT 'tt' || CAST(o_orderkey AS STRING) AS tconst,
       CAST(CAST(floor(o_totalprice) AS BIGINT) % 40 AS DOUBLE) / 4 AS averageRating,
       o_custkey AS numVotes
FROM {orders} WHERE o_totalprice > 100000"""

LIST_ROWS = """
SELECT CASE WHEN l_quantity = 50 THEN 'NA' ELSE 'tt' || CAST(l_orderkey AS STRING) END AS tconst,
       CAST(floor(l_extendedprice) AS BIGINT) % 250 + 1 AS rnk,
       CASE WHEN l_quantity = 1 THEN 'top' WHEN l_quantity = 2 THEN 'toptv'
            WHEN l_quantity = 3 THEN 'top-rated-indian-movies'
            WHEN l_quantity = 4 THEN 'top-rated-malayalam-movies'
            WHEN l_quantity = 5 THEN 'top-rated-tamil-movies'
            WHEN l_quantity = 6 THEN 'top-rated-telugu-movies'
            WHEN l_quantity = 7 THEN '?release_date=2009-01-01,2010-12-31&groups=top_1000'
            WHEN l_quantity = 8 THEN '?primary_language=ml&sort=moviemeter,asc'
            WHEN l_quantity = 9 THEN '?primary_language=ta&sort=num_votes,desc'
            WHEN l_quantity = 10 THEN '?primary_language=hi&sort=moviemeter,asc'
            WHEN l_quantity = 11 THEN '?primary_language=te&sort=num_votes,desc'
            WHEN l_quantity = 12 THEN '?primary_language=xx&sort=num_votes,desc'
            WHEN l_quantity < 20 THEN 'other'
            ELSE '?release_date=,9999-12-31&moviemeter=' || CAST(l_linenumber * 50 + 1 AS STRING)
                 || ',' || CAST(l_linenumber * 50 + 50 AS STRING) END AS type
FROM {lineitem}"""

LANG = """
SELECT CASE n_nationkey WHEN 0 THEN 'ml' WHEN 1 THEN 'ta' WHEN 2 THEN 'te' WHEN 3 THEN 'hi'
            WHEN 4 THEN 'kn' ELSE 'n' || CAST(n_nationkey AS STRING) END AS lang_code,
       n_name AS lang_name
FROM {nation}"""

GROSS_ROWS = """
SELECT 'tt' || CAST(l_orderkey AS STRING) AS tconst, 'Order ' || CAST(o_custkey AS STRING) AS movie_name,
       CAST(year(o_orderdate) AS BIGINT) AS movie_year, CAST(floor(l_extendedprice) AS BIGINT) AS box_office
FROM {sales} WHERE l_returnflag = 'R' AND o_orderstatus = 'F'
UNION ALL
SELECT 'NA', 'Order ' || CAST(o_custkey AS STRING),
       CAST(year(o_orderdate) AS BIGINT), CAST(floor(l_extendedprice) AS BIGINT)
FROM {sales} WHERE l_returnflag = 'A' OR (l_returnflag = 'R' AND o_orderstatus = 'F')"""

TITLE_CREW = """
SELECT 'tt' || CAST(l_orderkey AS STRING) AS tconst,
       'nm' || CAST(min(CASE WHEN l_returnflag = 'N' THEN l_suppkey END) AS STRING)
           || ',nm' || CAST(max(CASE WHEN l_returnflag = 'N' THEN l_suppkey END) AS STRING) AS directors,
       'nm' || CAST(max(CASE WHEN l_linestatus = 'O' THEN l_suppkey END) AS STRING) AS writers
FROM {lineitem} GROUP BY l_orderkey"""

PRINCIPALS = """
SELECT 'tt' || CAST(l_orderkey AS STRING) AS tconst,
       CASE l_returnflag WHEN 'R' THEN 'actor' WHEN 'A' THEN 'actress' ELSE 'director' END AS category,
       'nm' || CAST(l_suppkey AS STRING) AS nconst
FROM {lineitem}"""

NAMES = """
SELECT 'nm' || CAST(s_suppkey AS STRING) AS nconst,
       'Person ' || CAST(s_suppkey % 70 AS STRING) AS primaryName,
       CAST(1900 + s_nationkey AS BIGINT) AS birthYear,
       CASE WHEN s_acctbal > 5000 THEN CAST(1980 + s_nationkey AS BIGINT) END AS deathYear,
       CASE WHEN s_nationkey < 12 THEN 'actor' ELSE 'director,writer' END AS primaryProfession,
       CASE WHEN s_nationkey <> 3 THEN known END AS knownForTitles
FROM {supplier} LEFT JOIN (
    SELECT l_suppkey, 'tt' || CAST(min(l_orderkey) AS STRING) || ',tt' || CAST(max(l_orderkey) AS STRING)
           || ',tt' || CAST(max(CASE WHEN l_quantity = 50 THEN l_orderkey ELSE -1 END) AS STRING)
           || ',tt' || CAST(min(CASE WHEN l_tax = 0 THEN l_orderkey ELSE 0 END) AS STRING) AS known
    FROM {lineitem} GROUP BY l_suppkey) ON l_suppkey = s_suppkey"""

# A gold-shaped table straight from orders, for checks of the measure layer.
MODEL = """
SELECT 'tt' || CAST(o_orderkey AS STRING) AS {id}, o_orderpriority AS {type},
       CAST(year(o_orderdate) AS BIGINT) AS {year}, 'Clerk ' || CAST(o_custkey AS STRING) AS {directors},
       CAST(o_custkey % 100 AS DOUBLE) / 4 AS avg_rating, CAST(o_custkey % 180 AS BIGINT) AS runtime_min,
       CAST(floor(o_totalprice) AS BIGINT) AS box_office, o_custkey AS num_votes,
       CAST(o_orderdate AS DATE) AS last_refresh_date,
       CASE WHEN o_totalprice > 490000 THEN 'Y' ELSE 'N' END AS {top}
FROM {orders}"""
_MODEL_NAMES = {
    "id": "Title ID", "type": "Title Type", "year": "Release Year",
    "directors": "Directors", "top": "Is Top Title",
}


def _fields(template: str) -> set[str]:
    return {name for _, name, _, _ in string.Formatter().parse(template) if name}


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with their orders."""
    lines = table(spark, sf, "lineitem").withColumn("o_orderkey", F.col("l_orderkey"))
    return skew_join(lines, table(spark, sf, "orders"), ["o_orderkey"])


def frame(spark: SparkSession, sf: str, template: str) -> DataFrame:
    names = _fields(template) - set(_MODEL_NAMES)
    tables = {n: sales(spark, sf) if n == "sales" else table(spark, sf, n) for n in names}
    labels = {k: f"`{v}`" for k, v in _MODEL_NAMES.items()}
    text = template
    for name, label in labels.items():
        text = text.replace("{" + name + "}", label)
    return spark.sql(text, **tables)


def inline(template: str) -> str:
    """The same SELECT for the oracle, usable as ``FROM {inline(X)} alias``."""
    names = {name: name for name in _fields(template)}
    names |= {"sales": "(lineitem JOIN orders ON l_orderkey = o_orderkey)"}
    names |= {k: f'"{v}"' for k, v in _MODEL_NAMES.items()}
    return "(" + template.format(**names) + ")"
