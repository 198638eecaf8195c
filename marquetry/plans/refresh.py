"""One full rebuild: dumps and landed pages to bronze, silver and gold tables."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.pages import extract_lookup, page_rejects, page_rows, read_pages
from ..sources.concurrent_jobs import run_together
from ..sources.delimited import load_all, table_name
from ..sources.manifest import Sites
from ..sources.scratch import scratch
from ..sources.tables import read_table, write_table
from .boxoffice import build_boxoffice
from .crew import build_crew, clustered
from .gold import build_gold
from .title import build_title
from .top_title import build_top_title

# The dumps of a run.
DUMPS = [
    "title.principals.tsv.gz",
    "name.basics.tsv.gz",
    "title.basics.tsv.gz",
    "title.crew.tsv.gz",
    "title.ratings.tsv.gz",
]


def refresh(
    spark: SparkSession,
    root: str,
    raw: str,
    list_pages: DataFrame,
    revenue_pages: DataFrame,
    language_pages: DataFrame,
    sites: Sites,
    run_date: datetime.date | None = None,
    gold_table: str = "t_catalogue",
    parallelism: int = 4,
    partitions: int | None = None,
) -> Mapping[str, DataFrame]:
    """Rebuild every table under ``root``; later layers read what was written.

    Page tables are ``(url, html)``. What was read from pages is written before it
    is used, since more than one later step needs it. Each dump is one compressed
    file, so its rows are spread over ``partitions``, by default one per core.
    Intermediate tables are this run's own and go with it, also if it fails.
    """
    with scratch(spark):
        return rebuild(
            spark, root, raw, list_pages, revenue_pages, language_pages, sites,
            run_date, gold_table, parallelism, partitions,
        )


def rebuild(
    spark: SparkSession,
    root: str,
    raw: str,
    list_pages: DataFrame,
    revenue_pages: DataFrame,
    language_pages: DataFrame,
    sites: Sites,
    run_date: datetime.date | None,
    gold_table: str,
    parallelism: int,
    partitions: int | None,
) -> Mapping[str, DataFrame]:
    """The steps of :func:`refresh`; the caller owns what they stage."""

    def save(df: DataFrame, schema: str, table: str) -> DataFrame:
        return write_table(df, root, schema, table)

    dumps = {table_name(d): f"{raw.rstrip('/')}/{d}" for d in DUMPS}
    width = partitions or spark.sparkContext.defaultParallelism
    bronze = load_all(spark, dumps, root, parallelism=parallelism, partitions=width)
    lists = save(read_pages(list_pages, sites), "bronze", "t_list_page")
    revenue = save(read_pages(revenue_pages, sites), "bronze", "t_revenue_page")
    lang = save(extract_lookup(language_pages), "bronze", "t_language")
    rejected = page_rejects(lists).unionByName(page_rejects(revenue))

    basics = bronze["t_title_basics"]
    title = save(build_title(basics, bronze["t_title_ratings"]), "silver", "t_title")
    silver = run_together(
        spark,
        {
            "t_top_title": lambda: save(build_top_title(page_rows(lists), lang), "silver", "t_top_title"),
            "t_boxoffice": lambda: save(build_boxoffice(page_rows(revenue), title), "silver", "t_boxoffice"),
            "t_crew": lambda: save(
                clustered(
                    build_crew(
                        bronze["t_title_crew"], bronze["t_title_principals"], bronze["t_name_basics"], basics
                    )
                ),
                "silver",
                "t_crew",
            ),
        },
        parallelism,
    )
    gold = build_gold(title, silver["t_crew"], silver["t_top_title"], silver["t_boxoffice"], run_date)
    save(gold, "gold", gold_table)
    return {
        **bronze,
        **silver,
        "t_title": title,
        "rejected_pages": rejected,
        gold_table: read_table(spark, root, "gold", gold_table),
    }
