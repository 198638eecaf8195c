"""The table builders, each on its catalogue-shaped analogue."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import boxoffice, crew, gold, title, top_title
from ..plans.gold import COLUMNS, TITLE_TYPES
from ..plans.model import model_projection
from ..plans.report import overview
from ..sources.concurrent_jobs import run_together
from ..sources.delimited import load_all
from ..sources.scratch import scratch_path, stage
from .analogues import (
    BASICS,
    GROSS_ROWS,
    LANG,
    LIST_ROWS,
    NAMES,
    PRINCIPALS,
    RATINGS,
    TITLE_CREW,
    frame,
    inline,
)
from .registry import check, table
from .scans import dump

RUN_DATE = datetime.date(2024, 5, 17)

TITLE_SQL = f"""
    SELECT b.tconst, titleType AS title_type, primaryTitle AS primary_title, originalTitle AS original_title,
           startYear AS release_year, CASE WHEN isAdult = 1 THEN 'Y' ELSE 'N' END AS is_adult,
           runtimeMinutes AS runtime_min, genres, averageRating AS avg_rating, numVotes AS num_votes
    FROM {inline(BASICS)} b LEFT JOIN {inline(RATINGS)} r ON b.tconst = r.tconst"""

TOP_SQL = f"""
    WITH listed AS (
        SELECT *, CASE WHEN starts_with(type, '?release_date=,9999')
                       THEN CAST(split_part(split_part(type, 'moviemeter=', 2), ',', 1) AS BIGINT) - 1
                       ELSE 0 END + rnk AS place,
               CASE WHEN starts_with(type, '?primary_language=') THEN type[19:20]
                    WHEN contains(type, 'malayalam') THEN 'ml' WHEN contains(type, 'tamil') THEN 'ta'
                    WHEN contains(type, 'telugu') THEN 'te' END AS code,
               starts_with(type, 'top') OR contains(type, 'top_1000') AS on_top
        FROM {inline(LIST_ROWS)} WHERE tconst <> 'NA')
    SELECT tconst, string_agg(DISTINCT lang_name, '; ' ORDER BY lang_name) AS language_lst,
           max(place) FILTER (on_top) AS top_title_rnk,
           max(place) FILTER (starts_with(type, '?release_date=,9999')) AS popularity_rnk,
           max(place) FILTER (type LIKE '?primary%,asc') AS language_popularity_rnk,
           max(place) FILTER (type LIKE '?primary%,desc') AS language_votes_rnk,
           max(place) FILTER (type = 'top') AS top_250_movie_rnk,
           max(place) FILTER (type = 'toptv') AS top_250_tv_rnk,
           max(place) FILTER (type LIKE '%indian%') AS top_indian_movie_rnk,
           max(place) FILTER (type LIKE '%malayalam%') AS top_malayalam_movie_rnk,
           max(place) FILTER (type LIKE '%tamil%') AS top_tamil_movie_rnk,
           max(place) FILTER (type LIKE '%telugu%') AS top_telugu_movie_rnk,
           CASE WHEN bool_or(contains(type, 'top_1000')) THEN 'Y' ELSE 'N' END AS is_top_1000_movie,
           CASE WHEN bool_or(on_top) THEN 'Y' ELSE 'N' END AS is_top_title
    FROM listed LEFT JOIN {inline(LANG)} ON code = lang_code GROUP BY tconst"""

BOX_SQL = f"""
    WITH g AS (SELECT * FROM {inline(GROSS_ROWS)}),
         ids AS (SELECT * FROM g WHERE tconst <> 'NA'),
         pairs AS (
            SELECT t.tconst, n.movie_name, n.movie_year, n.box_office, t.num_votes
            FROM g n JOIN ({TITLE_SQL}) t ON t.primary_title = n.movie_name AND t.release_year = n.movie_year
            WHERE n.tconst = 'NA' AND t.title_type = 'movie'
              AND t.tconst NOT IN (SELECT tconst FROM ids)
              AND NOT EXISTS (SELECT 1 FROM ids i WHERE i.movie_name = n.movie_name
                              AND i.movie_year = n.movie_year AND i.box_office = n.box_office)),
         placed AS (SELECT *, row_number() OVER (PARTITION BY movie_name, movie_year
                        ORDER BY num_votes DESC NULLS LAST, box_office DESC NULLS LAST, tconst) AS rn FROM pairs)
    SELECT tconst, max(box_office) AS box_office
    FROM (SELECT tconst, box_office FROM ids UNION ALL SELECT tconst, box_office FROM placed WHERE rn = 1)
    GROUP BY tconst"""

CREW_SQL = f"""
    WITH listed AS (SELECT tconst, 'director' AS category, unnest(string_split(directors, ',')) AS nconst
                    FROM {inline(TITLE_CREW)}
                    UNION ALL SELECT tconst, 'writer', unnest(string_split(writers, ',')) FROM {inline(TITLE_CREW)}),
         credits AS (SELECT * FROM listed
                     UNION SELECT * FROM {inline(PRINCIPALS)} WHERE category NOT IN ('director', 'writer')),
         known AS (SELECT nconst, unnest(string_split(knownForTitles, ',')) AS t FROM {inline(NAMES)}),
         labels AS (SELECT nconst, string_agg(DISTINCT label, ', ' ORDER BY label) AS known_for_titles
                    FROM known LEFT JOIN (SELECT tconst, primaryTitle || ' (' || startYear || ')' AS label
                                          FROM {inline(BASICS)}) ON tconst = t
                    GROUP BY nconst)
    SELECT tconst, category, primaryName AS name, birthYear AS birth_year, deathYear AS death_year,
           primaryProfession AS primary_profession, known_for_titles
    FROM credits JOIN {inline(NAMES)} USING (nconst) JOIN labels USING (nconst)"""

_CHARTS = [c for c in COLUMNS if c.endswith("_rnk") and c not in ("top_title_rnk", "overall_popularity_rnk")]
_STRENGTH = "box_office DESC NULLS LAST, num_votes DESC NULLS LAST, avg_rating DESC NULLS LAST, tconst"

GOLD_SQL = f"""
    WITH lists AS (
        SELECT tconst, string_agg(name, '; ' ORDER BY name) FILTER (category = 'director') AS director_lst,
               string_agg(name, '; ' ORDER BY name) FILTER (category = 'actor') AS actor_lst,
               string_agg(name, '; ' ORDER BY name) FILTER (category = 'actress') AS actress_lst
        FROM ({CREW_SQL}) GROUP BY tconst),
    star AS (
        SELECT t.*, l.director_lst, l.actor_lst, l.actress_lst, language_lst, box_office,
               top_title_rnk AS list_rnk, popularity_rnk, language_popularity_rnk, language_votes_rnk,
               {", ".join(f"coalesce({c}, 9999) AS {c}" for c in _CHARTS)},
               coalesce(is_top_1000_movie, 'N') AS is_top_1000_movie, coalesce(is_top_title, 'N') AS is_top_title
        FROM ({TITLE_SQL}) t LEFT JOIN lists l ON l.tconst = t.tconst
        LEFT JOIN ({TOP_SQL}) p ON p.tconst = t.tconst LEFT JOIN ({BOX_SQL}) b ON b.tconst = t.tconst
        WHERE title_type IN ({", ".join(repr(t) for t in TITLE_TYPES)}))
    SELECT tconst, title_type, primary_title, original_title, release_year, is_adult, runtime_min, genres,
           avg_rating, num_votes, {", ".join(_CHARTS)}, is_top_1000_movie, is_top_title, language_lst,
           box_office, director_lst, actor_lst, actress_lst, '2024-05-17' AS last_refresh_date,
           CASE WHEN is_top_title = 'Y' THEN row_number() OVER (
                ORDER BY {", ".join(_CHARTS)}, is_top_title DESC, {_STRENGTH}) ELSE 9999 END AS top_title_rnk,
           row_number() OVER (ORDER BY popularity_rnk NULLS LAST, language_popularity_rnk NULLS LAST,
                list_rnk NULLS LAST, language_votes_rnk NULLS LAST, {_STRENGTH}) AS overall_popularity_rnk
    FROM star"""


@check("""
    SELECT 't_title_basics' AS table_name, count(*) AS n_rows, CAST(sum(o_custkey) AS BIGINT) AS total,
           CAST(count(*) FILTER (o_orderstatus <> 'P') AS BIGINT) AS n_typed FROM orders
    UNION ALL SELECT 't_title_principals', count(*), CAST(sum(l_suppkey) AS BIGINT), count(*) FROM lineitem
    UNION ALL SELECT 't_title_ratings', count(*), CAST(sum(p_size) AS BIGINT), count(*) FROM part
    UNION ALL SELECT 't_name_basics', count(*), CAST(sum(s_nationkey) AS BIGINT), count(*) FROM supplier
    UNION ALL SELECT 't_title_crew', count(*), CAST(sum(c_nationkey) AS BIGINT), count(*) FROM customer""")
def build_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Five gzip dumps to typed tables; one dump has bad numbers in one column."""
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    bad = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    dumps = {
        "t_title_basics": table(spark, sf, "orders").select(
            F.col("o_custkey").alias("numVotes"), bad.alias("startYear"), F.col("o_orderpriority").alias("genres")
        ),
        "t_title_principals": table(spark, sf, "lineitem").select(
            F.col("l_suppkey").alias("numVotes"), F.col("l_linenumber").alias("startYear")
        ),
        "t_title_ratings": table(spark, sf, "part").select(
            F.col("p_size").alias("numVotes"), F.col("p_size").alias("startYear"), "p_name"
        ),
        "t_name_basics": table(spark, sf, "supplier").select(
            F.col("s_nationkey").alias("numVotes"), F.col("s_nationkey").alias("startYear"), "s_name"
        ),
        "t_title_crew": table(spark, sf, "customer").select(
            F.col("c_nationkey").alias("numVotes"), F.col("c_nationkey").alias("startYear"), "c_name"
        ),
    }
    for name, df in dumps.items():
        dump(df, f"{raw}/{name}")
    loaded = load_all(spark, {name: f"{raw}/{name}" for name in dumps}, root)
    sums = [
        df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("numVotes").alias("total"),
            F.count("startYear").alias("n_typed"),
        ).select(F.lit(name).alias("table_name"), "n_rows", "total", "n_typed")
        for name, df in loaded.items()
    ]
    return reduce(DataFrame.union, sums)


@check(TITLE_SQL)
def build_title(spark: SparkSession, sf: str) -> DataFrame:
    return title.build_title(frame(spark, sf, BASICS), frame(spark, sf, RATINGS))


@check(TOP_SQL)
def build_top_title(spark: SparkSession, sf: str) -> DataFrame:
    return top_title.build_top_title(frame(spark, sf, LIST_ROWS), frame(spark, sf, LANG))


@check(BOX_SQL)
def build_boxoffice(spark: SparkSession, sf: str) -> DataFrame:
    # Both inputs are read several times, so they are written once, as in a refresh.
    gross = stage(frame(spark, sf, GROSS_ROWS), "gross")
    return boxoffice.build_boxoffice(gross, stage(build_title(spark, sf), "title"))


@check(CREW_SQL)
def build_crew(spark: SparkSession, sf: str) -> DataFrame:
    return crew.build_crew(
        frame(spark, sf, TITLE_CREW), frame(spark, sf, PRINCIPALS), frame(spark, sf, NAMES), frame(spark, sf, BASICS)
    )


def listed_crew(spark: SparkSession, sf: str) -> DataFrame:
    """The credits that gold lists."""
    inputs = [frame(spark, sf, x) for x in (TITLE_CREW, PRINCIPALS, NAMES, BASICS)]
    return crew.build_crew(*inputs, categories=list(gold.CREDIT_LISTS.values()), attributes=["name"])


# Copies of credits stay, and people without known titles keep theirs.
CREW_ALL_SQL = CREW_SQL.replace("UNION SELECT *", "UNION ALL SELECT *").replace("JOIN labels", "LEFT JOIN labels")


@check(CREW_ALL_SQL)
def crew_options(spark: SparkSession, sf: str) -> DataFrame:
    inputs = [frame(spark, sf, x) for x in (TITLE_CREW, PRINCIPALS, NAMES, BASICS)]
    return crew.build_crew(*inputs, dedupe=False, keep_without_titles=True)


@check(GOLD_SQL)
def build_gold(spark: SparkSession, sf: str) -> DataFrame:
    # Titles and revenue rows are read several times, so they are written once, as in a refresh.
    # Gold reads the others once: they are not written, and only what it asks of them is made.
    silver = run_together(
        spark,
        {
            "title": lambda: stage(build_title(spark, sf), "title"),
            "gross": lambda: stage(frame(spark, sf, GROSS_ROWS), "gross"),
            "crew": lambda: listed_crew(spark, sf),
            "top": lambda: build_top_title(spark, sf),
        },
        parallelism=4,
    )
    revenue = boxoffice.build_boxoffice(silver["gross"], silver["title"])
    built = gold.build_gold(silver["title"], silver["crew"], silver["top"], revenue, RUN_DATE)
    return built.withColumn("last_refresh_date", F.col("last_refresh_date").cast("string"))


@check(f"""
    WITH g AS (SELECT * FROM ({GOLD_SQL}) WHERE release_year IN (1995, 1996) AND contains(actor_lst, 'Person 1'))
    SELECT 'bar: ' || title_type AS item, count(*) AS titles, CAST(NULL AS VARCHAR) AS day FROM g GROUP BY title_type
    UNION ALL SELECT 'card', count(*), max(last_refresh_date) FROM g""")
def report_overview(spark: SparkSession, sf: str) -> DataFrame:
    """Bar chart and card of the report page over the gold table, under two slicers."""
    # The page reads its model once, so gold is not written for it.
    model = model_projection(build_gold(spark, sf))
    page = overview(model, {"Release Year": [1995, 1996]}, {"Actors": "Person 1"})
    bar = page["bar"].select(
        F.concat(F.lit("bar: "), "Title Type").alias("item"), F.col("Title #").alias("titles"), F.lit(None).cast("string").alias("day")
    )
    return bar.union(page["card"].select(F.lit("card"), "Title #", "Data as of"))
