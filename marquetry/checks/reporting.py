"""Measure and report checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.gold import COLUMNS
from ..plans.model import DISPLAY_NAMES, default_summary as summed, measures, model_projection
from ..plans.report import CARD_MEASURES, TEXT_SLICERS, VALUE_SLICERS, overview, summarize
from ..plans.report import filter_context as context, slicer_values as offered
from .analogues import MODEL, frame, inline
from .registry import check, table

_MODEL = inline(MODEL)
LINK = "https://catalogue.example/title/"


def _plain(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


@check(f"""
    SELECT "Release Year" AS release_year, avg(avg_rating) AS avg_rating, avg(runtime_min) AS avg_runtime
    FROM {_MODEL} GROUP BY 1""")
def measure_avg(spark: SparkSession, sf: str) -> DataFrame:
    result = summarize(frame(spark, sf, MODEL), ["Release Year"], ["Avg Rating", "Avg Runtime (mins)"])
    names = {"Release Year": "release_year", "Avg Rating": "avg_rating", "Avg Runtime (mins)": "avg_runtime"}
    return _plain(result, names)


@check(f"""
    SELECT "Title Type" AS kind, CAST(sum(box_office) AS BIGINT) AS box_office, CAST(sum(num_votes) AS BIGINT) AS votes
    FROM {_MODEL} GROUP BY 1""")
def measure_sum(spark: SparkSession, sf: str) -> DataFrame:
    result = summarize(frame(spark, sf, MODEL), ["Title Type"], ["Box Office $", "Number of Votes"])
    return _plain(result, {"Title Type": "kind", "Box Office $": "box_office", "Number of Votes": "votes"})


@check(f"""
    WITH s AS (SELECT "Directors" AS clerk, CAST(sum(box_office) AS BIGINT) AS v FROM {_MODEL} GROUP BY 1
               UNION ALL SELECT 'all of ' || "Title Type", CAST(sum(box_office) AS BIGINT) FROM {_MODEL} GROUP BY 1
               UNION ALL SELECT "Title ID", box_office % 1000 FROM {_MODEL})
    SELECT clerk, CASE
        WHEN v >= 1000000000 THEN '$' || replace(format('{{:,.1f}}', CAST(CAST(floor((v + 50000000) / 100000000) AS BIGINT) AS DOUBLE) / 10), '.0', '') || 'B'
        WHEN v >= 1000000 THEN '$' || format('{{:,}}', (v + 500000) // 1000000) || 'M'
        WHEN v >= 1000 THEN '$' || format('{{:,}}', (v + 500) // 1000) || 'K'
        ELSE '$' || format('{{:,}}', v) END AS label
    FROM s""")
def currency_label(spark: SparkSession, sf: str) -> DataFrame:
    model, label = frame(spark, sf, MODEL), ["Box Office Label"]
    parts = [
        summarize(model, ["Directors"], label),
        summarize(model, ["Title Type"], label).withColumn("Title Type", F.concat(F.lit("all of "), "Title Type")),
        summarize(model.withColumn("box_office", F.col("box_office") % 1000), ["Title ID"], label),
    ]
    return parts[0].union(parts[1]).union(parts[2]).toDF("clerk", "label")


@check(f"""
    SELECT "Title Type" AS kind, CAST(max(last_refresh_date) AS VARCHAR) AS data_as_of FROM {_MODEL} GROUP BY 1""")
def measure_max_date(spark: SparkSession, sf: str) -> DataFrame:
    result = summarize(frame(spark, sf, MODEL), ["Title Type"], ["Data as of"])
    return result.select(F.col("Title Type").alias("kind"), F.col("Data as of").cast("string").alias("data_as_of"))


@check(f"""
    SELECT "Directors" AS clerk, "Release Year" AS release_year, '{LINK}' ||
           CASE WHEN count(DISTINCT "Title ID") = 1 THEN max("Title ID") ELSE '' END || '/' AS link
    FROM {_MODEL} GROUP BY 1, 2""")
def selected_value(spark: SparkSession, sf: str) -> DataFrame:
    by = ["Directors", "Release Year"]
    result = summarize(frame(spark, sf, MODEL), by, ["Title Link"], catalog=measures(LINK))
    return _plain(result, {"Directors": "clerk", "Release Year": "release_year", "Title Link": "link"})


@check(f"""
    SELECT "Directors" AS clerk, CASE WHEN bool_or("Is Top Title" = 'Y') THEN 'Green' END AS color
    FROM {_MODEL} GROUP BY 1""")
def any_flag(spark: SparkSession, sf: str) -> DataFrame:
    result = summarize(frame(spark, sf, MODEL), ["Directors"], ["Font Color"])
    return _plain(result, {"Directors": "clerk", "Font Color": "color"})


@check(
    "SELECT "
    + ", ".join(f"o_orderkey || ' {c}' AS \"{DISPLAY_NAMES[c]}\"" for c in COLUMNS if c != "tconst")
    + ", o_orderkey AS \"Title ID\" FROM orders",
    "model_projection",
)
def model_projection_orders(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    marked = [F.concat(key, F.lit(f" {c}")).alias(c) for c in COLUMNS if c != "tconst"]
    return model_projection(table(spark, sf, "orders").select(key.alias("tconst"), *marked))


@check(f"""
    SELECT "Title Type" AS kind, CAST(sum(runtime_min) AS BIGINT) AS runtime_min, sum(avg_rating) AS avg_rating,
           CAST(sum(num_votes) AS BIGINT) AS num_votes, CAST(sum(box_office) AS BIGINT) AS box_office
    FROM {_MODEL} GROUP BY 1""")
def default_summary(spark: SparkSession, sf: str) -> DataFrame:
    model = frame(spark, sf, MODEL)
    return model.groupBy(F.col("Title Type").alias("kind")).agg(*summed(model.columns).values())


@check(f"""
    SELECT "Title Type" AS kind, count(*) AS titles FROM {_MODEL} GROUP BY 1""")
def count_by_category(spark: SparkSession, sf: str) -> DataFrame:
    result = summarize(frame(spark, sf, MODEL), ["Title Type"], ["Title #"], order="Title #")
    return _plain(result, {"Title Type": "kind", "Title #": "titles"})


@check(f"""
    SELECT DISTINCT "Release Year" AS release_year FROM {_MODEL} WHERE contains("Directors", '77')""")
def slicer_values(spark: SparkSession, sf: str) -> DataFrame:
    values = offered(frame(spark, sf, MODEL), "Release Year", context(texts={"Directors": "77"}))
    return values.select(F.col("Release Year").alias("release_year"))


@check(f"""
    SELECT "Title ID" AS id, "Directors" AS clerk FROM {_MODEL} WHERE contains("Directors", 'k 12')""")
def text_slicer(spark: SparkSession, sf: str) -> DataFrame:
    model = frame(spark, sf, MODEL).filter(context(texts={"Directors": "k 12"}))
    return _plain(model, {"Title ID": "id", "Directors": "clerk"})


_VALUES = {"Release Year": [1995, 1996, 1997], "Title Type": ["1-URGENT", "5-LOW", "2-HIGH"]}
_TEXTS = {"Directors": "1", "Title ID": "7"}
_WHERE = """"Release Year" IN (1995, 1996, 1997) AND "Title Type" IN ('1-URGENT', '5-LOW', '2-HIGH')
    AND "Directors" LIKE '%1%' AND "Title ID" LIKE '%7%'"""


@check(f"""
    SELECT "Title Type" AS kind, count(*) AS titles, avg(avg_rating) AS avg_rating
    FROM {_MODEL} WHERE {_WHERE} GROUP BY 1""")
def filter_context(spark: SparkSession, sf: str) -> DataFrame:
    shown = ["Title #", "Avg Rating"]
    result = summarize(frame(spark, sf, MODEL), ["Title Type"], shown, context(_VALUES, _TEXTS), "Title #")
    return _plain(result, {"Title Type": "kind", "Title #": "titles", "Avg Rating": "avg_rating"})


@check(f"""
    SELECT count(*) AS titles, avg(avg_rating) AS avg_rating, CAST(max(last_refresh_date) AS VARCHAR) AS data_as_of
    FROM {_MODEL} WHERE {_WHERE}""")
def card_summary(spark: SparkSession, sf: str) -> DataFrame:
    card = summarize(frame(spark, sf, MODEL), [], CARD_MEASURES, context(_VALUES, _TEXTS))
    return card.select(
        F.col("Title #").alias("titles"),
        F.col("Avg Rating").alias("avg_rating"),
        F.col("Data as of").cast("string").alias("data_as_of"),
    )


_SLICERS = [*VALUE_SLICERS, *TEXT_SLICERS]
_CHOSEN = {"Release Year": [1995, 1996]}
_TYPED = {"Directors": "7"}
# The slicers that the model of orders lacks are made from its other columns.
_MORE = {
    "Primary Title": "o_orderkey % 50", "Generes": "o_orderpriority", "Actors": "o_orderstatus",
    "Actresses": "CASE WHEN o_custkey % 3 = 0 THEN o_orderstatus END", "Languages": "o_custkey % 10",
}
_PAGE = (
    "SELECT CAST(year(o_orderdate) AS BIGINT) AS \"Release Year\", 'Clerk ' || CAST(o_custkey AS VARCHAR) AS \"Directors\", "
    + ", ".join(f"CAST({sql} AS VARCHAR) AS \"{name}\"" for name, sql in _MORE.items())
    + " FROM orders"
)


def _others(own: str) -> str:
    years = "1 = 1" if own == "Release Year" else '"Release Year" IN (1995, 1996)'
    return years + ("" if own == "Directors" else " AND contains(\"Directors\", '7')")


@check(
    f"WITH page AS ({_PAGE}) "
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS slicer, CAST(\"{c}\" AS VARCHAR) AS offered FROM page WHERE {_others(c)}" for c in _SLICERS
    )
)
def overview_slicers(spark: SparkSession, sf: str) -> DataFrame:
    """What the seven slicers offer while one of them is set and another one typed into."""
    orders = table(spark, sf, "orders").select(
        F.year("o_orderdate").cast("bigint").alias("Release Year"),
        F.concat(F.lit("Clerk "), F.col("o_custkey").cast("string")).alias("Directors"),
        *[F.expr(sql).cast("string").alias(name) for name, sql in _MORE.items()],
        *[F.lit(1).alias(c) for c in ("avg_rating", "last_refresh_date")],
        F.col("o_orderpriority").alias("Title Type"),
        F.lit("N").alias("Is Top Title"),
        F.col("o_orderkey").alias("Title ID"),
        *[F.lit(1).alias(c) for c in ("runtime_min", "box_office", "num_votes")],
    )
    page = overview(orders, _CHOSEN, _TYPED)
    lists = [
        page[f"slicer: {c}"].select(F.lit(c).alias("slicer"), F.col(f"`{c}`").cast("string").alias("offered"))
        for c in _SLICERS
    ]
    return reduce(DataFrame.union, lists)
