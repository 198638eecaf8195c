"""Silver credits table: one row per credit of a person on a title."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.groups import sorted_set
from ..operators.joins import skew_join
from ..operators.reshape import explode_list, unpivot_lists
from ..sources.scratch import stage

# Categories that come from the per-title lists instead of the
# principal credits.
LISTED = {"director": "directors", "writer": "writers"}
# What is kept of a person.
ATTRIBUTES = ["name", "birth_year", "death_year", "primary_profession", "known_for_titles"]


def build_credits(
    title_crew: DataFrame, principals: DataFrame, dedupe: bool = True, categories: Sequence[str] | None = None
) -> DataFrame:
    """(tconst, category, nconst) of the ``categories`` (all, by default); a credit without category is left out."""
    lists = {c: column for c, column in LISTED.items() if categories is None or c in categories}
    listed = unpivot_lists(title_crew, "tconst", lists, "category", "nconst") if lists else None
    others = principals.filter(~F.col("category").isin(*LISTED)).select("tconst", "category", "nconst")
    if categories is not None:
        others = others.filter(F.col("category").isin(*categories))
    both = others.union(listed.select("tconst", "category", "nconst")) if lists else others
    return both.distinct() if dedupe else both


def build_people(names: DataFrame, basics: DataFrame, keep_without_titles: bool = False) -> DataFrame:
    """One row per person with the titles they are known for as one text."""
    known = explode_list(names.select("nconst", "knownForTitles"), "knownForTitles", "_title")
    label = F.concat("primaryTitle", F.lit(" ("), F.col("startYear").cast("string"), F.lit(")"))
    titles = basics.select(F.col("tconst").alias("_title"), label.alias("_label"))
    labels = sorted_set(F.col("_label"))
    # Only ids and labels move here; the set is no larger than the cell it was split from.
    texts = (
        skew_join(known, titles, ["_title"], "left")
        .groupBy("nconst")
        .agg(F.when(F.size(labels) > 0, F.array_join(labels, ", ")).alias("known_for_titles"))
    )
    people = names.select(
        "nconst",
        F.col("primaryName").alias("name"),
        F.col("birthYear").alias("birth_year"),
        F.col("deathYear").alias("death_year"),
        F.col("primaryProfession").alias("primary_profession"),
    )
    return people.join(texts, "nconst", "left" if keep_without_titles else "inner")


def build_crew(
    title_crew: DataFrame,
    principals: DataFrame,
    names: DataFrame,
    basics: DataFrame,
    dedupe: bool = True,
    keep_without_titles: bool = False,
    categories: Sequence[str] | None = None,
    attributes: Sequence[str] = ATTRIBUTES,
) -> DataFrame:
    """Credits with person attributes; a person with very many credits is salted.

    ``categories`` and ``attributes`` say which credits and what of a person are wanted, if
    not all; the rest is never moved. There are far fewer people than credits, so they are
    staged and Spark knows their size: up to its threshold they are sent to the credits,
    beyond it both are shuffled.
    """
    credits = build_credits(title_crew, principals, dedupe, categories)
    people = build_people(names, basics, keep_without_titles).select("nconst", *attributes)
    joined = skew_join(credits, stage(people, "people"), ["nconst"], derived=True)
    return joined.select("tconst", "category", *attributes)


def clustered(crew: DataFrame) -> DataFrame:
    """Order for writing: equal names end up in one file and compress well.

    The further keys let a name with very many rows span several files.
    """
    keys = ["name", "tconst", "category"]
    return crew.repartitionByRange(*keys).sortWithinPartitions(*keys)
