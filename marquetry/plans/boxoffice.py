"""Silver revenue table: one row per title with known revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.pages import NO_ID
from ..operators.resolve import resolve_entities


def build_boxoffice(gross_rows: DataFrame, title: DataFrame) -> DataFrame:
    """Revenue of rows with an id, and of name rows resolved to a movie.

    A title on several pages keeps its largest revenue.
    """
    rows = gross_rows.select("tconst", "movie_name", "movie_year", "box_office")
    with_id = rows.filter(F.col("tconst") != NO_ID)
    resolved = resolve_entities(
        with_id,
        rows.filter(F.col("tconst") == NO_ID),
        title.filter(F.col("title_type") == "movie").select(
            "tconst",
            F.col("primary_title").alias("movie_name"),
            F.col("release_year").alias("movie_year"),
            "num_votes",
        ),
        key="tconst",
        on=["movie_name", "movie_year"],
        value="box_office",
        prefer=F.col("num_votes"),
    )
    return (
        with_id.select("tconst", "box_office")
        .unionByName(resolved)
        .groupBy("tconst")
        .agg(F.max("box_office").alias("box_office"))
    )
