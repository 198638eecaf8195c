"""Gold table: one row per title with lists, ranks and revenue."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.groups import cond_list
from ..operators.rank import cond_rank, dist_row_number
from ..sources.concurrent_jobs import run_together
from ..sources.scratch import stage
from .top_title import CHARTS

# Title types kept, rank of a title that is on no list, list columns.
TITLE_TYPES = ["movie", "tvMiniSeries", "short", "tvSeries", "tvShort", "tvSpecial"]
UNRANKED = 9999
CREDIT_LISTS = {"director_lst": "director", "actor_lst": "actor", "actress_lst": "actress"}

STRENGTH = ["box_office", "num_votes", "avg_rating"]

COLUMNS = [
    "tconst", "title_type", "primary_title", "original_title", "release_year", "is_adult",
    "runtime_min", "genres", "avg_rating", "num_votes", "top_title_rnk", *CHARTS,
    "is_top_1000_movie", "is_top_title", "language_lst", "box_office", *CREDIT_LISTS,
    "last_refresh_date", "overall_popularity_rnk",
]


def credit_lists(crew: DataFrame, copied: bool = True) -> DataFrame:
    """Director, actor and actress names per title; not ``copied``: each person's credit is one row."""
    listed = crew.filter(F.col("category").isin(*CREDIT_LISTS.values()))
    tests = {name: F.col("category") == category for name, category in CREDIT_LISTS.items()}
    return cond_list(listed, ["tconst"], F.col("name"), tests, copied=copied)


def gold_star(
    title: DataFrame, crew: DataFrame, top: DataFrame, boxoffice: DataFrame
) -> DataFrame:
    """Titles of the kept types with credits, lists and revenue.

    Credits and revenue come down to one row per title before they are joined, so
    all three joins are one-to-one on the same key and share its partitioning.
    """
    kept = title.filter(F.col("title_type").isin(*TITLE_TYPES))
    return with_lists_and_revenue(kept.join(credit_lists(crew), "tconst", "left"), top, boxoffice)


def with_lists_and_revenue(
    titles: DataFrame, top: DataFrame, boxoffice: DataFrame
) -> DataFrame:
    revenue = boxoffice.groupBy("tconst").agg(F.max("box_office").alias("box_office"))
    return (
        titles.join(top, "tconst", "left")
        .join(revenue, "tconst", "left")
        .withColumns({rank: F.coalesce(rank, F.lit(UNRANKED).cast("bigint")) for rank in CHARTS})
        .withColumns(
            {flag: F.coalesce(flag, F.lit("N")) for flag in ("is_top_1000_movie", "is_top_title")}
        )
    )


def build_gold(
    title: DataFrame,
    crew: DataFrame,
    top: DataFrame,
    boxoffice: DataFrame,
    run_date: datetime.date | None = None,
) -> DataFrame:
    """The star with its two overall ranks; ties are broken by the unique title id.

    Lists and revenue join the titles once, and the result is staged: both ranks sort
    its narrow key columns, and it then meets the credit lists and the ranks one-to-one.
    The lists of credits are never moved after their own aggregation, and come from the
    credits in one shuffle: a person is listed once per credit, so a title has as many
    rows as its lists have names. ``crew``, ``top`` and ``boxoffice`` are read once.
    """
    by_strength = [*[F.col(c).desc_nulls_last() for c in STRENGTH], F.col("tconst").asc()]
    by_popularity = [
        F.col("popularity_rnk").asc_nulls_last(),
        F.col("language_popularity_rnk").asc_nulls_last(),
        F.col("top_title_rnk").asc_nulls_last(),
        F.col("language_votes_rnk").asc_nulls_last(),
        *by_strength,
    ]
    day = F.current_date() if run_date is None else F.lit(run_date)
    kept = title.filter(F.col("title_type").isin(*TITLE_TYPES))
    titles = stage(with_lists_and_revenue(kept, top, boxoffice), "titles")
    by_chart = [*[F.col(rank).asc() for rank in CHARTS], *by_strength]
    behind = F.struct(*CHARTS) > F.struct(*[F.lit(UNRANKED).cast("bigint").alias(r) for r in CHARTS])
    ranks = run_together(
        titles.sparkSession,
        {
            # This order still sees the list rank that the chart rank replaces.
            "popularity": lambda: dist_row_number(titles, by_popularity, "overall_popularity_rnk", keep=["tconst"]),
            # Titles on a top list sort before all others, so only they are sorted.
            "charted": lambda: cond_rank(
                titles, F.col("is_top_title") == "Y", by_chart, "_chart_rnk", UNRANKED, behind, ["tconst"]
            ),
        },
        parallelism=2,
    )
    return (
        titles.join(credit_lists(crew, copied=False), "tconst", "left")
        .join(ranks["popularity"], "tconst")
        .join(ranks["charted"], "tconst")
        .withColumns({"top_title_rnk": F.col("_chart_rnk"), "last_refresh_date": day})
        .select(*COLUMNS)
    )
