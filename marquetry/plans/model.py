"""Names and measures over the gold table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import currency_label

ID_LABEL = "Title ID"

# Display name of each gold column, in model order. The name of the
# id column is the caller's choice.
DISPLAY_NAMES = {
    "overall_popularity_rnk": "Popularity Rank",
    "tconst": ID_LABEL,
    "title_type": "Title Type",
    "primary_title": "Primary Title",
    "original_title": "Original Title",
    "release_year": "Release Year",
    "is_adult": "Is Adult",
    "runtime_min": "runtime_min",
    "genres": "Generes",
    "avg_rating": "avg_rating",
    "num_votes": "num_votes",
    "box_office": "box_office",
    "top_250_movie_rnk": "Top 250 Movie Rank",
    "is_top_1000_movie": "Is Top 1000 Movie",
    "language_lst": "Languages",
    "director_lst": "Directors",
    "actor_lst": "Actors",
    "actress_lst": "Actresses",
    "last_refresh_date": "last_refresh_date",
    "is_top_title": "Is Top Title",
    "top_250_tv_rnk": "Top 250 TV Rank",
    "top_indian_movie_rnk": "Top Indian Movie Rank",
    "top_malayalam_movie_rnk": "Top Malayalam Movie Rank",
    "top_tamil_movie_rnk": "Top Tamil Movie Rank",
    "top_telugu_movie_rnk": "Top Telugu Movie Rank",
    "top_title_rnk": "Top Title Rank",
}
# Columns that only serve measures, and those summed by default.
HIDDEN = ["runtime_min", "avg_rating", "num_votes", "box_office", "last_refresh_date"]
SUMMED = ["runtime_min", "avg_rating", "num_votes", "box_office"]


def model_projection(gold: DataFrame, id_label: str = ID_LABEL, hidden: bool = True) -> DataFrame:
    """Gold columns under their display names, hidden ones on request left out."""
    names = DISPLAY_NAMES | {"tconst": id_label}
    return gold.select(
        *[F.col(c).alias(n) for c, n in names.items() if hidden or c not in HIDDEN]
    )


def selected_value(column: Column) -> Column:
    """The value of ``column`` if the rows hold exactly one, null otherwise."""
    single = (F.count(column) == F.count(F.lit(1))) & (F.min(column) == F.max(column))
    return F.when(single, F.max(column))


def measures(link_prefix: str = "", id_column: str = ID_LABEL) -> dict[str, Column]:
    """Named aggregates over :func:`model_projection`, for any grouping."""
    box_office = F.sum("box_office")
    is_top = F.max(F.coalesce(F.col("Is Top Title") == "Y", F.lit(False)))
    link = F.concat(
        F.lit(link_prefix), F.coalesce(selected_value(F.col(id_column)), F.lit("")), F.lit("/")
    )
    return {
        "Avg Rating": F.avg("avg_rating"),
        "Avg Runtime (mins)": F.avg("runtime_min"),
        "Box Office $": box_office,
        "Box Office Label": currency_label(box_office),
        "Data as of": F.max("last_refresh_date"),
        "Number of Votes": F.sum("num_votes"),
        "Title #": F.count(F.lit(1)),
        "Title Link": link,
        "Font Color": F.when(is_top, F.lit("Green")),
    }


def default_summary(columns: list[str]) -> dict[str, Column]:
    """Sums of the columns that are summed when dropped on a report as they are."""
    return {c: F.sum(c).alias(c) for c in columns if c in SUMMED}


def pick(catalog: Mapping[str, Column], names: list[str]) -> list[Column]:
    return [catalog[n].alias(n) for n in names]
