"""Silver title table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import yes_no


def build_title(basics: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row per title with its rating, if it has one."""
    return basics.join(ratings, "tconst", "left").select(
        "tconst",
        F.col("titleType").alias("title_type"),
        F.col("primaryTitle").alias("primary_title"),
        F.col("originalTitle").alias("original_title"),
        F.col("startYear").alias("release_year"),
        yes_no(F.col("isAdult") == 1).alias("is_adult"),
        F.col("runtimeMinutes").alias("runtime_min"),
        "genres",
        F.col("averageRating").alias("avg_rating"),
        F.col("numVotes").alias("num_votes"),
    )
