"""The plan of pages to land, as a table of addresses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Charts, languages, sort orders and release windows to land.
CHARTS = ["chart/toptv/", "chart/top/"]
REGIONAL_CHARTS = ["indian", "malayalam", "tamil", "telugu"]
LANGUAGES = ["ml", "ta", "hi", "te", "kn"]
SORTS = ["moviemeter,asc", "num_votes,desc"]
RELEASE_WINDOWS = [
    ("1900-01-01", "1940-12-31"),
    ("1941-01-01", "1950-12-31"),
    ("1951-01-01", "1958-12-31"),
    ("1959-01-01", "1963-12-31"),
    ("1964-01-01", "1970-12-31"),
    ("1971-01-01", "1975-12-31"),
    ("1976-01-01", "1982-12-31"),
    ("1983-01-01", "1987-12-31"),
    ("1988-01-01", "1991-12-31"),
    ("1992-01-01", "1994-12-31"),
    ("1995-01-01", "1997-12-31"),
    ("1998-01-01", "2000-12-31"),
    ("2001-01-01", "2002-12-31"),
    ("2003-01-01", "2004-09-30"),
    ("2004-10-01", "2006-12-31"),
    ("2007-01-01", "2008-12-31"),
    ("2009-01-01", "2010-12-31"),
    ("2011-01-01", "2012-12-31"),
    ("2013-01-01", "2014-06-30"),
    ("2014-07-01", "2015-12-31"),
    ("2016-01-01", "2017-12-31"),
    ("2018-01-01", "2019-12-31"),
    ("2020-01-01", "2022-12-31"),
    ("2023-01-01", "9999-12-31"),
]
FIRST_REVENUE_YEAR = 1977


@dataclass(frozen=True)
class Sites:
    """Where pages come from; the two roots are the caller's, the rest is layout."""

    lists: str  # root of the site with charts and searches, ending in "/"
    revenue: str  # root of the site with revenue tables, without final "/"

    @property
    def search(self) -> str:
        return f"{self.lists}search/title/"

    @property
    def revenue_year(self) -> str:
        return f"{self.revenue}/year/world/"

    @property
    def revenue_chart(self) -> str:
        return f"{self.revenue}/chart/ww_top_lifetime_gross/?area=XWW&offset="


def windows(first: Column, last: Column, step: int) -> Column:
    """Start positions ``first, first+step, … ≤ last``; none if ``last < first``."""
    return F.when(last >= first, F.sequence(first, last, F.lit(step).cast("bigint")))


def paged_search(df: DataFrame, total: str, step: int, prefix: Column) -> DataFrame:
    """One ``{prefix}{n},{n+step-1}`` address per window of each row's ``total``."""
    starts = windows(F.lit(1).cast("bigint"), F.col(total).cast("bigint"), step)
    return df.withColumn("_n", F.explode(starts)).select(
        *df.columns, F.concat(prefix, F.col("_n"), F.lit(","), F.col("_n") + (step - 1)).alias("url")
    )


def source_manifest(spark: SparkSession, run_year: int, sites: Sites) -> DataFrame:
    """Every page of a run: (kind, url)."""

    def kind(name: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(name).alias("kind"), F.col("url"))

    one = spark.range(1)
    charts = [sites.lists + c for c in CHARTS]
    charts += [f"{sites.lists}india/top-rated-{r}-movies/" for r in REGIONAL_CHARTS]
    ranked = kind("list", spark.createDataFrame([(u,) for u in charts], "url string"))
    by_language = (
        one.select(F.explode(F.array(*map(F.lit, LANGUAGES))).alias("lang"))
        .select("lang", F.explode(F.array(*map(F.lit, SORTS))).alias("sort"))
        .select(
            F.concat(
                F.lit(f"{sites.search}?primary_language="), "lang", F.lit("&sort="), "sort"
            ).alias("url")
        )
    )
    by_release = spark.createDataFrame(RELEASE_WINDOWS, "start string, stop string").select(
        F.concat(
            F.lit(f"{sites.search}?release_date="), "start", F.lit(","), "stop",
            F.lit("&groups=top_1000"),
        ).alias("url")
    )
    popular = paged_search(
        one.select(F.lit(1999).alias("total")),
        "total",
        50,
        F.lit(f"{sites.search}?release_date=,9999-12-31&moviemeter="),
    )
    years = spark.range(FIRST_REVENUE_YEAR, run_year + 1).select(
        F.concat(F.lit(sites.revenue_year), "id").alias("url")
    )
    offsets = spark.range(0, 10_000, 200).select(
        F.concat(F.lit(sites.revenue_chart), "id").alias("url")
    )
    return (
        ranked.union(kind("list", by_language))
        .union(kind("list", by_release))
        .union(kind("list", popular))
        .union(kind("revenue", years))
        .union(kind("revenue", offsets))
    )
