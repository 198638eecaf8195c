"""Silver table of list memberships: one row per listed title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import yes_no
from ..operators.groups import cond_max
from ..operators.pages import NO_ID
from ..sources.scratch import stage

# How a list type tells which list it is.
BY_LANGUAGE = "%primary_language%,%"
BY_POPULARITY = "%release_date%moviemeter%"
LANGUAGE_OF_QUERY = "primary_language=([a-z]+)"
FIRST_PLACE_OF_PAGE = r"moviemeter=(\d+),"
LANGUAGE_OF_CHART = {"%malayalam%": "ml", "%tamil%": "ta", "%telugu%": "te"}
CHARTS = {
    "top_250_movie_rnk": "top",
    "top_250_tv_rnk": "toptv",
    "top_indian_movie_rnk": "top-rated-indian-movies",
    "top_malayalam_movie_rnk": "top-rated-malayalam-movies",
    "top_tamil_movie_rnk": "top-rated-tamil-movies",
    "top_telugu_movie_rnk": "top-rated-telugu-movies",
}


def list_language(kind: Column) -> Column:
    """Language code of a list, null for lists of any language."""
    code = F.when(kind.like(BY_LANGUAGE), F.regexp_extract(kind, LANGUAGE_OF_QUERY, 1))
    for pattern, language in LANGUAGE_OF_CHART.items():
        code = code.when(kind.like(pattern), F.lit(language))
    return code


def places_before(kind: Column) -> Column:
    """Places on earlier pages of a paged list, 0 for other lists."""
    first = F.regexp_extract(kind, FIRST_PLACE_OF_PAGE, 1).try_cast("bigint")
    return F.when(kind.like(BY_POPULARITY), first - 1).otherwise(F.lit(0).cast("bigint"))


def list_flags(kind: Column) -> dict[str, Column]:
    charts = {f"on_{rank}": kind == name for rank, name in CHARTS.items()}
    return charts | {
        "in_top_1000": kind.like("%top_1000%"),
        "is_popular": kind.like(BY_POPULARITY),
        "is_primary_lang": kind.like(BY_LANGUAGE),
        "is_asc": kind.like("%,asc%"),
        "is_desc": kind.like("%,desc%"),
    }


def on_top_list(flags: dict[str, Column]) -> Column:
    found = flags["in_top_1000"]
    for rank in CHARTS:
        found = found | flags[f"on_{rank}"]
    return found


def described(kinds: DataFrame) -> DataFrame:
    """Language code, page offset and the flags of each list type, as booleans."""
    flags = list_flags(F.col("type"))
    return kinds.select(
        "type",
        list_language(F.col("type")).alias("lang_code"),
        places_before(F.col("type")).alias("_before"),
        *[test.alias(name) for name, test in flags.items()],
        on_top_list(flags).alias("is_top_title"),
    )


def typed_rows(list_rows: DataFrame, lang: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The list rows, and each of their list types described, with the language name given ``lang``.

    There are far fewer list types than rows, so the patterns run once per type and
    the rows look the outcome up; the types are staged, so Spark knows their size and
    sends them to the rows if they are as few as pages make them.
    """
    typed = list_rows.select("tconst", "rnk", F.coalesce("type", F.lit("")).alias("type"))
    lists = described(typed.select("type").distinct())
    if lang is not None:
        lists = lists.join(lang.select("lang_code", "lang_name"), "lang_code", "left")
    return typed, stage(lists, "lists")


def with_overall_rank(typed: DataFrame, lists: DataFrame) -> DataFrame:
    rows = typed.join(lists, "type", "left")
    return rows.withColumn("rnk", F.col("rnk").cast("bigint") + F.col("_before")).drop("_before")


def looked_up(list_rows: DataFrame, lang: DataFrame | None) -> DataFrame:
    """List rows with overall rank, boolean flags and, given ``lang``, the language name."""
    return with_overall_rank(*typed_rows(list_rows, lang))


def flag_lists(list_rows: DataFrame, lang: DataFrame | None = None) -> DataFrame:
    """List rows with overall rank, Y/N flags and, given ``lang``, the language name."""
    rows = looked_up(list_rows, lang)
    flags = [name for name, kind in rows.dtypes if kind == "boolean"]
    return rows.withColumns({name: yes_no(F.col(name)) for name in flags})


#: Languages whose marks one number holds.
MARKS = 62


def build_top_title(list_rows: DataFrame, lang: DataFrame) -> DataFrame:
    """Languages, ranks and flags per title, in one aggregate.

    Everything combines map-side in buffers of fixed size, so a title listed very often
    sends one partial row per task: maxima, and a bit for each language that any list
    type names, in as many numbers as that takes.
    """
    known = list_rows.filter(F.col("tconst").isNotNull() & (F.col("tconst") != NO_ID))
    typed, lists = typed_rows(known, lang)
    # No more than there are languages.
    names = sorted(r[0] for r in lists.select("lang_name").distinct().collect() if r[0] is not None)
    primary = F.col("is_primary_lang")
    ranks = {
        "top_title_rnk": F.col("is_top_title"),
        "popularity_rnk": F.col("is_popular"),
        "language_popularity_rnk": primary & F.col("is_asc"),
        "language_votes_rnk": primary & F.col("is_desc"),
    } | {rank: F.col(f"on_{rank}") for rank in CHARTS}
    place = F.array_position(F.lit(names).cast("array<string>"), F.col("lang_name")) - 1
    words = range(0, len(names), MARKS)

    def own(word: int) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_lang") - word).cast("int"))
        return F.bit_or(F.when(F.col("_lang").between(word, word + MARKS - 1), bit)).alias(f"_langs{word}")

    def named(word: int) -> Column:
        marks = F.coalesce(F.col(f"_langs{word}"), F.lit(0).cast("long"))
        part = F.lit(names[word : word + MARKS]).cast("array<string>")
        return F.filter(part, lambda name, i: F.call_function("shiftright", marks, i).bitwiseAND(F.lit(1).cast("long")) == 1)

    languages = F.concat(*[named(w) for w in words]) if names else F.array().cast("array<string>")
    return (
        with_overall_rank(typed, lists.withColumn("_lang", place).drop("lang_name"))
        .groupBy("tconst")
        .agg(
            *[own(w) for w in words],
            *cond_max(ranks, F.col("rnk")),
            yes_no(F.max("in_top_1000")).alias("is_top_1000_movie"),
            yes_no(F.max("is_top_title")).alias("is_top_title"),
        )
        .withColumn("_names", languages)
        .select(
            "tconst",
            F.when(F.size("_names") > 0, F.array_join("_names", "; ")).alias("language_lst"),
            *ranks,
            "is_top_1000_movie",
            "is_top_title",
        )
    )
