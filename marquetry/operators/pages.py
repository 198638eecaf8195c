"""Landed pages ``(url, html)`` to rows, as one scan of column expressions.

A page yields all of its rows or, if any part of it cannot be read, none; such
pages come out of :func:`rejects` with the reason. A table within a cell is text of
that cell: its rows and cells are not taken for those of the table around it.

Pages may carry a ``position``, any value that sorts as the input does (such as
:func:`landed_pages` gives them). Rows then have it too, with their ``place`` in the
page, and rejects have it, so input order can be had back after any shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import (
    bind,
    first_table,
    markup_text,
    money,
    non_empty,
    path_part,
    row_cells,
    source_type,
    table_rows,
    title_id,
    uncommented,
)
from ..sources.manifest import Sites

# What a row without id, rank or revenue carries.
NO_ID = "NA"
NO_NUMBER = -1

ROWS = (
    "array<struct<tconst:string,rnk:bigint,type:string,movie_name:string,"
    "movie_year:bigint,box_office:bigint>>"
)

# Where the three page layouts keep their list. Leaves are read as
# text so that a number sent as text is not an error.
_NODE = "struct<id:string,titleText:struct<text:string>,releaseYear:struct<year:string>>"
_ITEMS = (
    f"array<struct<currentRank:string,node:{_NODE},item:{_NODE},"
    "titleId:string,titleText:string,releaseYear:string>>"
)
_PAGE_DATA = (
    "_bad string, props struct<pageProps:struct<"
    f"pageData:struct<chartTitles:struct<edges:{_ITEMS}>>,"
    "cmsContext:struct<transformedPlacements:struct<`center-3`:"
    f"struct<transformedArguments:struct<items:{_ITEMS}>>>>,"
    f"searchResults:struct<titleResults:struct<titleListItems:{_ITEMS}>>>>"
)
_LISTS = [
    ["pageData", "chartTitles", "edges"],
    ["cmsContext", "transformedPlacements", "center-3", "transformedArguments", "items"],
    ["searchResults", "titleResults", "titleListItems"],
]
_SCRIPT = r"""(?is)<script\b[^>]*\bid\s*=\s*["']?__NEXT_DATA__["']?[^>]*>(.*?)</script\s*>"""


def _list_read(url: Column, html: Column, sites: Sites) -> Column:
    """struct(rows, reason) of a page with an embedded list."""
    kind = source_type(url, sites.search)

    def row(x: Column, i: Column) -> Column:
        def own(*path: str) -> Column:
            node, item = x["node"], x["item"]
            for step in path:
                node, item = node[step], item[step]
            return non_empty(F.when(filled(x["node"]), node).otherwise(item))

        def filled(node: Column) -> Column:
            """An empty object counts as none."""
            return node["id"].isNotNull() | node["titleText"].isNotNull() | node["releaseYear"].isNotNull()

        def year(text: Column) -> Column:
            return F.nullif(text.try_cast("bigint"), F.lit(0).cast("bigint"))

        rank = F.nullif(x["currentRank"].try_cast("bigint"), F.lit(0).cast("bigint"))
        return F.struct(
            F.coalesce(own("id"), non_empty(x["titleId"]), F.lit(NO_ID)).alias("tconst"),
            F.coalesce(rank, (i + 1).cast("bigint")).alias("rnk"),
            kind.alias("type"),
            F.coalesce(own("titleText", "text"), x["titleText"]).alias("movie_name"),
            F.coalesce(year(own("releaseYear", "year")), year(x["releaseYear"])).alias("movie_year"),
            F.lit(NO_NUMBER).cast("bigint").alias("box_office"),
        )

    def lists_of(data: Column) -> list[Column]:
        lists = []
        for path in _LISTS:
            found = data["props"]["pageProps"]
            for step in path:
                found = found[step]
            lists.append(found)
        return lists

    def of_data(data: Column) -> Column:
        lists = lists_of(data)
        filled = F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists])
        return F.struct(
            F.transform(filled, row).cast(ROWS).alias("rows"),
            F.when(data["_bad"].isNotNull(), "embedded data is not readable")
            .when(F.coalesce(*lists).isNull(), "no list found")
            .alias("reason"),
        )

    def of_script(script: Column) -> Column:
        data = F.from_json(script, _PAGE_DATA, {"columnNameOfCorruptRecord": "_bad"})
        return F.when(script != "", bind(data, of_data)).otherwise(_no_rows("no embedded data"))

    return bind(F.regexp_extract(html, _SCRIPT, 1), of_script)


def _table_read(url: Column, html: Column, sites: Sites) -> Column:
    """struct(rows, reason) of a page with a revenue table."""
    yearly = page_layout(url, sites) == "yearly table"

    def whole(text: Column) -> Column:
        return F.replace(text, F.lit(","), F.lit("")).try_cast("bigint")

    def row(c: Column) -> Column:
        link = F.regexp_extract(F.get(c, 1), r"(?is)<a\b([^>]*)>", 1)

        def of_texts(t: Column) -> Column:
            return F.struct(
                F.when(yearly, F.lit(NO_ID)).otherwise(title_id(link)).alias("tconst"),
                F.when(yearly, F.lit(NO_NUMBER).cast("bigint")).otherwise(whole(F.get(t, 0))).alias("rnk"),
                F.when(yearly, F.lit(NO_ID)).otherwise(path_part(url, -2)).alias("type"),
                F.get(t, 1).alias("movie_name"),
                F.when(yearly, path_part(url, -1).try_cast("bigint"))
                .otherwise(whole(F.get(t, 7)))
                .alias("movie_year"),
                money(F.get(t, 2)).alias("box_office"),
            )

        return bind(F.transform(F.slice(c, 1, 8), markup_text), of_texts)

    def complete(r: Column) -> Column:
        ok = F.lit(True)
        for name in ("tconst", "rnk", "movie_name", "movie_year", "box_office"):
            ok = ok & r[name].isNotNull()
        return ok

    def of_rows(rows: Column) -> Column:
        readable = F.forall(rows, complete)
        return F.struct(
            rows.cast(ROWS).alias("rows"),
            F.when(~readable, "a table row is not readable").alias("reason"),
        )

    def of_table(table: Column) -> Column:
        cells = F.filter(
            F.transform(table_rows(table), lambda r: row_cells(r, "td")), lambda c: F.size(c) > 0
        )
        read = bind(F.transform(cells, row), of_rows)
        return F.when(table.isNotNull(), read).otherwise(_no_rows("no table"))

    return bind(first_table(uncommented(html)), of_table)


def _no_rows(reason: str) -> Column:
    return F.struct(F.lit(None).cast(ROWS).alias("rows"), F.lit(reason).alias("reason"))


def page_layout(url: Column, sites: Sites) -> Column:
    """Which of the layouts a page has, told by its address."""
    return (
        F.when(F.contains(url, F.lit(sites.revenue_year)), "yearly table")
        .when(F.contains(url, F.lit(sites.revenue)), "chart table")
        .otherwise("list")
    )


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, html, position) of landed Parquet files; the position is file and row in it."""
    pages = spark.read.parquet(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return pages.select("url", "html", place.alias("position"))


def carried(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c == "position"]


def read_pages(pages: DataFrame, sites: Sites) -> DataFrame:
    """(url, rows, reason) of every page, each read by the layout of its site, and its position if it has one.

    The result goes through ``inline`` so that a later filter on ``reason`` sees
    finished columns instead of reading the page a second time.
    """
    read = _reader(sites, id(pages.sparkSession._jvm))
    return pages.select("url", F.inline(F.array(read)), *carried(pages))


@lru_cache(maxsize=8)
def _reader(sites: Sites, _jvm: int) -> Column:
    """What a page of ``url`` and ``html`` reads as; some hundred expressions, so made once per process."""
    url, html = F.col("url"), F.col("html")
    return F.when(page_layout(url, sites) == "list", _list_read(url, html, sites)).otherwise(
        _table_read(url, html, sites)
    )


def page_rows(read: DataFrame) -> DataFrame:
    """tconst, rnk, type, movie_name, movie_year, box_office, url; of pages with a position also that and place (from 1)."""
    good, own = read.filter(F.col("reason").isNull()), carried(read)
    if not own:
        return good.select("url", F.explode("rows").alias("r")).select("r.*", "url")
    rows = good.select("url", "position", F.posexplode("rows").alias("place", "r"))
    return rows.select("r.*", "url", "position", (F.col("place") + 1).cast("bigint").alias("place"))


def page_rejects(read: DataFrame) -> DataFrame:
    return read.filter(F.col("reason").isNotNull()).select("url", "reason", *carried(read))


def in_input_order(rows: DataFrame) -> DataFrame:
    """Rows or rejects of pages with positions, in the order in which the input has them."""
    return rows.orderBy(*[c for c in ("position", "place") if c in rows.columns])


def extract_all(pages: DataFrame, sites: Sites) -> DataFrame:
    """Rows of all pages."""
    return page_rows(read_pages(pages, sites))


def extract_ranked_list(pages: DataFrame, sites: Sites) -> DataFrame:
    return extract_all(pages.filter(~F.contains("url", F.lit(sites.revenue))), sites)


def extract_gross_table(pages: DataFrame, sites: Sites) -> DataFrame:
    return extract_all(pages.filter(F.contains("url", F.lit(sites.revenue))), sites)


def rejects(pages: DataFrame, sites: Sites) -> DataFrame:
    """(url, reason) of the pages that gave no rows because they cannot be read, and their position."""
    return page_rejects(read_pages(pages, sites))


# Heading parts of the language-code table.
LANGUAGE_HEADINGS = {"lang_name": "ISO Language Names", "lang_code": "Set 1"}


def extract_lookup(
    pages: DataFrame,
    headings: Mapping[str, str] = LANGUAGE_HEADINGS,
    skip: int = 2,
    strict: bool = True,
) -> DataFrame:
    """Columns of the first ``wikitable``, found by a part of their heading.

    The first ``skip`` table rows are headings. A page without the table or one of
    the columns fails the job, or gives no rows if not ``strict``.
    """
    opening = r"""(?i)<table\b[^>]*\bclass\s*=\s*["'][^"'>]*\bwikitable\b[^>]*>"""
    table = F.coalesce(first_table(uncommented(F.col("html")), opening), F.lit(""))
    texts = F.transform(
        bind(table, table_rows), lambda r: F.transform(row_cells(r, "td|th"), _stripped)
    )

    def place(heads: Column, part: str) -> Column:
        hits = F.transform(heads, lambda h: F.contains(h, F.lit(part)))
        return F.nullif(F.array_position(hits, True), F.lit(0).cast("bigint")).cast("int") - 1

    def body(rows: Column, places: Column) -> Column:
        found = F.lit(True)
        for name in headings:
            found = found & places[name].isNotNull()
        message = F.concat(F.lit("expected table or columns not found: "), F.col("url"))
        filled = F.filter(F.slice(rows, F.lit(skip + 1), F.size(rows)), lambda r: F.size(r) > 0)
        picked = F.transform(
            filled, lambda r: F.struct(*[F.get(r, places[name]).alias(name) for name in headings])
        )
        return F.when(found, picked).otherwise(F.raise_error(message) if strict else F.lit(None))

    def read(rows: Column) -> Column:
        places = F.struct(*[place(F.get(rows, 0), part).alias(n) for n, part in headings.items()])
        return bind(places, lambda p: body(rows, p))

    return pages.select(F.inline(bind(texts, read)))


def _stripped(cell: Column) -> Column:
    """Cell text without white space of any kind at its ends."""
    return F.regexp_replace(markup_text(cell), r"^[\s\u00a0]+|[\s\u00a0]+$", "")
