"""Page extraction checks.

The test tables hold no catalogue pages, so pages are rendered from a table and
read back; the oracle is a plain SELECT of that table. A page holds 50 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import element, elements, markup_text, source_type
from ..operators.pages import (
    extract_gross_table,
    extract_lookup,
    extract_ranked_list,
    in_input_order,
    page_layout,
    rejects,
)
from ..operators.rank import dist_row_number
from ..sources.manifest import Sites
from .registry import check, table

SITES = Sites(lists="https://lists.example/", revenue="https://revenue.example")
PAGE_ROWS = 50


def on_pages(df: DataFrame, key: str, item: Column, between: str) -> DataFrame:
    """(page, body): the items of 50 consecutive keys, in key order."""
    page = F.floor(F.col(key) / PAGE_ROWS).cast("bigint")
    items = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), item.alias("item"))))
    body = F.array_join(F.transform(items, lambda x: x["item"]), between)
    return df.groupBy(page.alias("page")).agg(body.alias("body"))


def list_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as ranked lists in the three layouts, by page number."""
    page = F.floor(F.col("p_partkey") / PAGE_ROWS)
    key = F.when(F.col("p_size") != 1, F.concat(F.lit("tt"), "p_partkey"))
    year = F.col("p_size") + 1900
    rank = F.when(F.col("p_size") == 2, 0).otherwise(F.col("p_size"))
    node = F.struct(
        key.alias("id"),
        F.struct(F.col("p_name").alias("text")).alias("titleText"),
        F.struct(year.alias("year")).alias("releaseYear"),
    )
    flat = F.struct(key.alias("titleId"), F.col("p_name").alias("titleText"), year.alias("releaseYear"))
    # An empty node stands for none, and a year of 0 leaves it to the year beside.
    empty = F.struct(F.lit(None).cast("string").alias("id"))
    yearless = node.withField("releaseYear", F.struct(F.lit(0).alias("year")))
    beside = F.struct(rank.alias("currentRank"), yearless.alias("node"), year.alias("releaseYear"))
    item = (
        F.when((page % 3 == 0) & (F.col("p_size") % 7 == 3), F.to_json(beside))
        .when(page % 3 == 0, F.to_json(F.struct(rank.alias("currentRank"), node.alias("node"))))
        .when((page % 3 == 1) & (F.col("p_size") % 5 == 3), F.to_json(F.struct(empty.alias("node"), node.alias("item"))))
        .when(page % 3 == 1, F.to_json(F.struct(node.alias("item"))))
        .otherwise(F.to_json(flat))
    )
    listed = on_pages(table(spark, sf, "part"), "p_partkey", item, ",")

    def wrapped(before: str, after: str) -> Column:
        return F.concat(F.lit(before), "body", F.lit(after))

    data = (
        F.when(F.col("page") % 3 == 0, wrapped('{"pageData":{"chartTitles":{"edges":[', "]}}}"))
        .when(
            F.col("page") % 3 == 1,
            wrapped(
                '{"cmsContext":{"transformedPlacements":{"center-3":{"transformedArguments":{"items":[', "]}}}}}"
            ),
        )
        .otherwise(
            wrapped(
                '{"pageData":{"chartTitles":{"edges":[]}},"searchResults":{"titleResults":{"titleListItems":[',
                "]}}}",
            )
        )
    )
    address = (
        F.when(F.col("page") % 3 == 0, F.concat(F.lit("chart/top"), "page", F.lit("/")))
        .when(F.col("page") % 3 == 1, F.concat(F.lit("india/top-rated-"), "page", F.lit("-movies/")))
        .otherwise(F.concat(F.lit("search/title/?release_date=,9999-12-31&moviemeter="), "page"))
    )
    html = F.concat(
        F.lit('<html><script>var x = 1;</script><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":'),
        data,
        F.lit("}}</script><p>end</p></html>"),
    )
    return listed.select("page", F.concat(F.lit(SITES.lists), address).alias("url"), html.alias("html"))


@check("""
    WITH p AS (SELECT *, p_partkey // 50 AS page FROM part)
    SELECT CASE WHEN p_size = 1 THEN 'NA' ELSE 'tt' || p_partkey END AS tconst,
           CAST(CASE WHEN page % 3 = 0 AND p_size <> 2 THEN p_size
                     ELSE row_number() OVER (PARTITION BY page ORDER BY p_partkey) END AS BIGINT) AS rnk,
           CASE page % 3 WHEN 0 THEN 'top' || page WHEN 1 THEN 'top-rated-' || page || '-movies'
                ELSE '?release_date=,9999-12-31&moviemeter=' || page END AS type,
           p_name AS movie_name, CAST(1900 + p_size AS BIGINT) AS movie_year, CAST(-1 AS BIGINT) AS box_office
    FROM p""")
def extract_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return extract_ranked_list(list_pages(spark, sf), SITES).drop("url")


def revenue_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as yearly and chart revenue tables, by page number."""
    yearly = F.floor(F.col("p_partkey") / PAGE_ROWS) % 2 == 0
    name = F.concat("p_name", F.lit(" &amp; co&eacute; &ndash; &#x41;&lt; Caf&eacute Luna &ampx"))
    gross = F.concat(F.lit("$"), F.format_number(F.col("p_partkey") * 1234567, 0))
    place = F.format_number(F.col("p_partkey") + 1, 0)
    link = F.concat(F.lit('<a class="x" href="/title/tt'), "p_partkey", F.lit('/?ref=1">'), name, F.lit("</a>"))

    def cells(*parts: Column) -> Column:
        # Every third row leaves its end tags out.
        closed = F.when(F.col("p_partkey") % 3 != 0, F.lit("</td>")).otherwise(F.lit(""))
        opened = [F.concat(F.lit('<td class="c">'), part, closed) for part in parts]
        end = F.when(F.col("p_partkey") % 3 != 0, F.lit("</tr>")).otherwise(F.lit(""))
        return F.concat(F.lit("<tr>"), *opened, end)

    # A table within a cell is the cell's, also where that has no end tag.
    inner = F.lit("<span>-</span><table><tr><td>in</td><td>$1</td></tr><tr><td>2<table><td>x</table></table>")
    filler = F.when(F.col("p_partkey") % 400 == 0, inner).otherwise(F.lit("<span>-</span>"))
    row = F.when(yearly, cells(place, name, gross, filler)).otherwise(
        cells(place, link, gross, filler, filler, filler, filler, (F.col("p_size") + 1900).cast("string"))
    )
    address = F.when(
        F.col("page") % 2 == 0, F.concat(F.lit(SITES.revenue_year), (1977 + F.col("page") % 40).cast("string"))
    ).otherwise(F.concat(F.lit(SITES.revenue_chart), "page"))
    html = F.concat(
        F.lit("<html><!-- <table><tr><td>1</td><td>old</td><td>$1</td></tr></table> -->"),
        F.lit("<table><tr><th>Rank</th><th>Name</th><th>Gross</th></tr>"),
        "body",
        F.lit("</table><table><tr><td>other</td></tr></table></html>"),
    )
    listed = on_pages(table(spark, sf, "part"), "p_partkey", row, "\n")
    return listed.select("page", address.alias("url"), html.alias("html"))


@check("""
    WITH p AS (SELECT *, p_partkey // 50 AS page FROM part)
    SELECT CASE page % 2 WHEN 0 THEN 'NA' ELSE 'tt' || p_partkey END AS tconst,
           CASE page % 2 WHEN 0 THEN -1 ELSE p_partkey + 1 END AS rnk,
           CASE page % 2 WHEN 0 THEN 'NA' ELSE 'ww_top_lifetime_gross' END AS type,
           p_name || ' & coé – A< Café Luna &x' AS movie_name,
           CAST(CASE page % 2 WHEN 0 THEN 1977 + page % 40 ELSE 1900 + p_size END AS BIGINT) AS movie_year,
           p_partkey * 1234567 AS box_office
    FROM p""")
def extract_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return extract_gross_table(revenue_pages(spark, sf), SITES).drop("url")


@check("SELECT c_name AS lang_name, 'c' || c_custkey AS lang_code FROM customer")
def extract_lookup_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    row = F.concat(
        F.lit("<tr><th>"), "c_custkey", F.lit("</th><td>\n <a href='#'>"), "c_name",
        F.lit(" </a></td><td>x<table class='wikitable'><tr><td>y</td><td>z</table></td><td> c"), "c_custkey", F.lit("\n</td></tr>\n<tr></tr>"),
    )
    listed = on_pages(table(spark, sf, "customer"), "c_custkey", row, "\n")
    html = F.concat(
        F.lit(
            "<table><tr><td>no</td></tr></table><table class='wikitable sortable'><thead><tr><th>No</th>"
            "<th>ISO Language Names (all)</th><th>Set 2</th><th>Set 1 code</th></tr></thead>"
            "<tr><th>#</th><th>name</th><th>b</th><th>a</th></tr>"
        ),
        "body",
        F.lit("</table>"),
    )
    return extract_lookup(listed.select(F.concat(F.lit("wiki/"), "page").alias("url"), html.alias("html")))


@check("""
    SELECT DISTINCT CASE page % 3 WHEN 0 THEN 'chart/top' || page || '/'
                    WHEN 1 THEN 'india/top-rated-' || page || '-movies/'
                    ELSE 'search/title/?release_date=,9999-12-31&moviemeter=' || page END AS address,
           CASE page % 10 WHEN 3 THEN 'no embedded data' WHEN 7 THEN 'embedded data is not readable'
                ELSE 'no list found' END AS reason, page AS position
    FROM (SELECT p_partkey // 50 AS page FROM part) WHERE page % 10 IN (3, 5, 7)
    UNION ALL SELECT url, 'no embedded data', 1000000000 + page_id FROM pages""")
def extract_rejects(spark: SparkSession, sf: str) -> DataFrame:
    html = (
        F.when(F.col("page") % 10 == 3, F.replace("html", F.lit("__NEXT_DATA__"), F.lit("OTHER")))
        .when(F.col("page") % 10 == 7, F.replace("html", F.lit("}}</script>"), F.lit(";</script>")))
        .when(F.col("page") % 10 == 5, F.regexp_replace("html", '"(edges|items|titleListItems)":', '"new":'))
        .otherwise(F.col("html"))
    )
    built = list_pages(spark, sf).select("url", html.alias("html"), F.col("page").alias("position"))
    given = table(spark, sf, "pages").select("url", "html", F.col("page_id") + 1_000_000_000)
    shuffled = built.union(given).repartition(7, "url")
    return in_input_order(rejects(shuffled, SITES)).select(
        F.replace("url", F.lit(SITES.lists), F.lit("")).alias("address"), "reason", "position"
    )


@check("""
    WITH p AS (SELECT *, p_partkey // 50 AS page FROM part WHERE (p_partkey // 50) % 3 = 2),
         rows AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY p_partkey) AS place FROM p)
    SELECT page AS position, place, p_name AS movie_name, row_number() OVER (ORDER BY page, place) AS ordinal FROM rows""")
def extract_in_input_order(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of shuffled pages, numbered in the order of the input."""
    pages = list_pages(spark, sf).filter("page % 3 = 2").withColumnRenamed("page", "position")
    rows = extract_ranked_list(pages.repartition(7, "url"), SITES)
    ordered = dist_row_number(rows.select("position", "place", "movie_name"), [F.col("position"), F.col("place")], "ordinal")
    return ordered.select("position", "place", "movie_name", "ordinal")


@check("""
    SELECT page_id, CASE WHEN contains(url, '/en/') THEN split_part(url, '/', -1)
                         ELSE split_part(url, '/', -2) END AS source
    FROM pages""")
def url_source_type(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", source_type(F.col("url"), "/en/").alias("source"))


@check("""
    SELECT page_id, CASE WHEN url LIKE '%.example.net/year/world/%' THEN 'yearly table'
                         WHEN url LIKE '%.example.net%' THEN 'chart table' ELSE 'list' END AS layout
    FROM pages""")
def route_pages(spark: SparkSession, sf: str) -> DataFrame:
    sites = Sites(lists="https://", revenue=".example.net")
    return table(spark, sf, "pages").select("page_id", page_layout(F.col("url"), sites).alias("layout"))


@check("""
    WITH nav AS (SELECT page_id, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') AS nav FROM pages),
         links AS (SELECT page_id, regexp_extract_all(nav, '<li><a [^>]*>(.*?)</a></li>', 1) AS texts FROM nav),
         rows AS (SELECT page_id, unnest(texts) AS text, generate_subscripts(texts, 1) AS pos FROM links)
    SELECT page_id, CAST(pos AS BIGINT) AS pos, replace(replace(replace(replace(
           text, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS text
    FROM rows""")
def html_list_posexplode(spark: SparkSession, sf: str) -> DataFrame:
    links = elements(element(F.col("html"), "nav"), "li")
    return (
        table(spark, sf, "pages")
        .select("page_id", F.posexplode(links).alias("pos", "item"))
        .select("page_id", (F.col("pos") + 1).cast("bigint").alias("pos"), markup_text(F.col("item")).alias("text"))
    )
