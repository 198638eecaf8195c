"""Page layouts, fallbacks and rejects on hand-made pages."""

from __future__ import annotations

import html
import json

import pytest
from pyspark.sql import functions as F

from marquetry.functions.text import currency_label, markup_text, money, running, title_id
from marquetry.operators.pages import (
    extract_all,
    extract_lookup,
    in_input_order,
    landed_pages,
    page_rejects,
    page_rows,
    read_pages,
    rejects,
)
from marquetry.sources.manifest import Sites, source_manifest

SITES = Sites(lists="https://lists.example/", revenue="https://revenue.example")
TOP = "https://lists.example/chart/top/"


def script(props) -> str:
    body = json.dumps({"props": {"pageProps": props}})
    return f'<html><body><script type="x" id="__NEXT_DATA__">{body}</script></body></html>'


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "url string, html string")


def read(spark, *rows):
    found = extract_all(pages(spark, *rows), SITES).collect()
    return [(r.tconst, r.rnk, r.type, r.movie_name, r.movie_year, r.box_office) for r in found]


def node(key=None, name=None, year=None):
    full = {"id": key, "titleText": {"text": name}, "releaseYear": {"year": year}}
    return {k: v for k, v in full.items() if v is not None}


def test_chart_layout_and_fallbacks(spark):
    edges = [
        {"currentRank": 3, "node": node("tt3", "Three", 2003)},
        {"currentRank": 0, "node": node("", "", 0), "titleId": "tt2", "titleText": "Two", "releaseYear": 2002},
        {"node": {"titleText": {"text": "No id"}}},
    ]
    assert read(spark, (TOP, script({"pageData": {"chartTitles": {"edges": edges}}}))) == [
        ("tt3", 3, "top", "Three", 2003, -1),
        ("tt2", 2, "top", "Two", 2002, -1),
        ("NA", 3, "top", "No id", None, -1),
    ]


def test_first_filled_layout_wins(spark):
    items = [{"item": node("tt5", "Five", 2005)}]
    hits = [{"titleId": "tt6", "titleText": "Six", "releaseYear": 2006}]
    both = {
        "pageData": {"chartTitles": {"edges": []}},
        "cmsContext": {"transformedPlacements": {"center-3": {"transformedArguments": {"items": items}}}},
        "searchResults": {"titleResults": {"titleListItems": hits}},
    }
    india = "https://lists.example/india/top-rated-tamil-movies/"
    search = "https://lists.example/search/title/?release_date=,9999-12-31&moviemeter=51,100"
    only_search = {"searchResults": both["searchResults"]}
    assert read(spark, (india, script(both)), (search, script(only_search))) == [
        ("tt5", 1, "top-rated-tamil-movies", "Five", 2005, -1),
        ("tt6", 1, "?release_date=,9999-12-31&moviemeter=51,100", "Six", 2006, -1),
    ]


YEAR = "https://revenue.example/year/world/1999"
CHART = "https://revenue.example/chart/ww_top_lifetime_gross/?area=XWW&offset=200"


def table(*rows):
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f"<p>x</p><TABLE class='t'>\n<tr><th>head</th></tr>{body}</TABLE><table><tr><td>no</td></tr></table>"


def test_yearly_and_chart_tables(spark):
    yearly = table(["1", "A &amp; B", "$1,234", "-"], ["2", " C&#39;s ", " 7 "])
    chart = table(["1,201", '<a class="q" href="/title/tt77/?r=1">Seven <i>7</i></a>', "$9", "", "", "", "", " 2001 "])
    assert read(spark, (YEAR, yearly), (CHART, chart)) == [
        ("NA", -1, "NA", "A & B", 1999, 1234),
        ("NA", -1, "NA", " C's ", 1999, 7),
        ("tt77", 1201, "ww_top_lifetime_gross", "Seven 7", 2001, 9),
    ]


def test_bad_pages_give_no_rows_and_are_reported(spark):
    good = table(["1", "A", "$5"])
    found = pages(
        spark,
        (YEAR, good),
        (YEAR + "#a", good),
        (YEAR.replace("1999", "2000"), table(["1", "A", "$5"], ["2", "B", "none"])),
        (YEAR.replace("1999", "2001"), table(["1", "A"])),
        (YEAR.replace("1999", "2002"), "<p>no table</p>"),
        (YEAR.replace("1999", "2003"), table()),
        (CHART, table(["1", "<a href='/x'>no id</a>", "$9", "", "", "", "", "2001"])),
        (TOP, "<html></html>"),
        (TOP + "2/", script({})[:-40]),
        (TOP + "3/", '<script id="__NEXT_DATA__">{"props": </script>'),
        (TOP + "4/", script({})),
    )
    both = read_pages(found, SITES)
    assert [r.url for r in page_rows(both).collect()] == [YEAR]
    reasons = {r.url: r.reason for r in page_rejects(both).collect()}
    assert reasons == {
        YEAR + "#a": "a table row is not readable",
        YEAR.replace("1999", "2000"): "a table row is not readable",
        YEAR.replace("1999", "2001"): "a table row is not readable",
        YEAR.replace("1999", "2002"): "no table",
        CHART: "a table row is not readable",
        TOP: "no embedded data",
        TOP + "2/": "no embedded data",
        TOP + "3/": "embedded data is not readable",
        TOP + "4/": "no list found",
    }
    assert {r.url: r.reason for r in rejects(found, SITES).collect()} == reasons


def test_page_is_read_once_when_filtered(spark):
    plan = page_rows(read_pages(pages(spark, (TOP, "")), SITES))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


WIKI = """<table class="other"><tr><td>x</td></tr></table>
<table class="wikitable sortable" id="t"><thead><tr><th colspan=2>ISO Language Names<sup>1</sup></th><th>Set 1</th></tr></thead>
<tr><th>a</th><th>b</th></tr><tr></tr>
<tr><th> <a href="#">Malayalam</a>
</th><td>
ml </td></tr><tr><td>Tamil&nbsp;</td><td>ta</td></tr></table>"""


def test_lookup(spark):
    got = extract_lookup(pages(spark, ("w", WIKI))).collect()
    assert [(r.lang_name, r.lang_code) for r in got] == [("Malayalam", "ml"), ("Tamil", "ta")]


@pytest.mark.parametrize("html", ["<p></p>", WIKI.replace("Set 1", "Set 9"), WIKI.replace("wikitable", "w")])
def test_lookup_missing(spark, html):
    assert extract_lookup(pages(spark, ("w", html)), strict=False).count() == 0
    with pytest.raises(Exception, match="not found: w"):
        extract_lookup(pages(spark, ("w", html))).collect()


def test_text_functions(spark):
    df = spark.createDataFrame(
        [("a &lt;b&gt; &amp;lt; &#233;&#x1F600; &#; &#xD800; &#9999999; &nope;",)], "t string"
    )
    got = df.select(markup_text(F.concat(F.lit("<i>"), "t", F.lit("</i>")))).first()[0]
    assert got == "a <b> &lt; é😀 &#; &#xD800; &#9999999; &nope;"
    values = spark.createDataFrame([("$1,234",), ("x",), (None,)], "t string").select(money(F.col("t"))).collect()
    assert [r[0] for r in values] == [1234, None, None]
    links = spark.createDataFrame([("/title/tt012/tt3",), ("/x",)], "t string").select(title_id(F.col("t"))).collect()
    assert [r[0] for r in links] == ["tt012", None]


def test_currency_label(spark):
    amounts = [None, 0, 999, 1000, 1499, 1_500_000, 999_499_999, 10**9, 2_150_000_000, 1_234_000_000_000, -5]
    df = spark.createDataFrame([(a,) for a in amounts], "a bigint").select(currency_label(F.col("a")))
    assert [r[0] for r in df.collect()] == [
        None, "$0", "$999", "$1K", "$1K", "$2M", "$999M", "$1B", "$2.2B", "$1,234B", "-$5",
    ]


def test_manifest(spark):
    manifest = source_manifest(spark, 2024, SITES)
    counts = {r.kind: r["count"] for r in manifest.groupBy("kind").count().collect()}
    assert counts == {"list": 2 + 4 + 10 + 24 + 40, "revenue": 48 + 50}
    urls = [r.url for r in manifest.collect()]
    assert len(set(urls)) == len(urls)
    assert {
        "https://lists.example/chart/toptv/",
        "https://lists.example/india/top-rated-telugu-movies/",
        "https://lists.example/search/title/?primary_language=kn&sort=num_votes,desc",
        "https://lists.example/search/title/?release_date=2023-01-01,9999-12-31&groups=top_1000",
        "https://lists.example/search/title/?release_date=,9999-12-31&moviemeter=1951,2000",
        "https://revenue.example/year/world/2024",
        "https://revenue.example/chart/ww_top_lifetime_gross/?area=XWW&offset=9800",
    } <= set(urls)


def test_open_cells_comments_and_named_references(spark):
    rows = "<tr><td>1<td>Am&eacute;lie &ndash; &amp;lt; x &unknown;<td>$5<tr><td>2</td><td>B</td><td>$6"
    html = f"<!-- <table><tr><td>0</td><td>old</td><td>$1</td></tr></table> --><table>{rows}</table>"
    assert read(spark, (YEAR, html)) == [
        ("NA", -1, "NA", "Amélie – &lt; x &unknown;", 1999, 5),
        ("NA", -1, "NA", "B", 1999, 6),
    ]


def test_an_empty_node_counts_as_none(spark):
    edges = [{"node": {}, "item": node("tt9", "Nine", 2009)}, {"item": node("tt8", "Eight", 0), "releaseYear": 2008}]
    assert read(spark, (TOP, script({"pageData": {"chartTitles": {"edges": edges}}}))) == [
        ("tt9", 1, "top", "Nine", 2009, -1),
        ("tt8", 2, "top", "Eight", 2008, -1),
    ]


def test_tables_within_cells(spark):
    """They are text of their cell; the table ends at its own end tag, a row at its own."""
    inner = "<table><tr><td>in</td><td>$7</td></tr><tr><td>deep<TABLE><td>x</table></table>"
    rows = (
        f"<tr><td>1<td>A {inner} b<td>$5<td>{inner}<tr><td>2</td><td>B</td><td>$6</td><td>{inner}</td></tr>"
        "<tbody><tr><td>3</td><td>C</td><td>$8</td></tr></tbody>"
    )
    html = f"<table class='t'>{rows}</table><table><tr><td>9</td><td>no</td><td>$9</td></tr></table>"
    assert read(spark, (YEAR, html)) == [
        ("NA", -1, "NA", "A in$7deepx b", 1999, 5),
        ("NA", -1, "NA", "B", 1999, 6),
        ("NA", -1, "NA", "C", 1999, 8),
    ]
    wiki = WIKI.replace("<td>ta</td>", f"<td>ta</td><td>{inner}</td>").replace("ml </td>", "ml </td><td><table class=wikitable><tr><td>q</table></td>")
    got = extract_lookup(pages(spark, ("w", wiki))).collect()
    assert [(r.lang_name, r.lang_code) for r in got] == [("Malayalam", "ml"), ("Tamil", "ta")]


def test_a_table_that_is_never_closed_ends_with_the_page(spark):
    html = "<table><tr><td>1<td>A<table><tr><td>x<td>$5"
    assert read(spark, (YEAR, html)) == []  # the inner table takes the rest, so no revenue is left
    assert read(spark, (YEAR, html.replace("<table><tr><td>x", "i"))) == [("NA", -1, "NA", "Ai", 1999, 5)]


def test_many_nested_tables(spark):
    """Depths of a long page, past the blocks in which they are summed up."""
    inner = "<table><tr><td>i<table><tr><td>j</td></tr></table></td></tr></table>"
    body = "".join(f"<tr><td>{i}</td><td>N{i}{inner}</td><td>${i}</td></tr>" for i in range(400))
    got = read(spark, (YEAR, f"<p><table>{body}</table>"))
    assert [(r[3], r[5]) for r in got] == [(f"N{i}ij", i) for i in range(400)]


def test_running_sums(spark):
    values = [[], [1], [1, -1, 2], list(range(-30, 71))]
    df = spark.createDataFrame([(v,) for v in values], "v array<int>").select("v", running(F.col("v")).alias("s"))
    for r in df.collect():
        assert r["s"] == [sum(r["v"][: i + 1]) for i in range(len(r["v"]))]


def test_references_as_a_parser_reads_them(spark):
    texts = [
        "Caf&eacute Luna", "&ampx &AMP;&ltx &notit; &notin; &copycat &Aacutex &aacute;", "&#39 &#x41g &#65;&#x1F600;",
        "&amp;lt; && & &; &nosuch; &x", "&thetasym;&theta &ThickSpace;|", "&frac12&frac123 &sup1st",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["t"] for r in df.select("i", markup_text(F.col("t")).alias("t")).collect()}
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts]


def test_positions_survive_a_shuffle(spark, tmp_path):
    made = [(f"https://lists.example/chart/top{i}/", script({"pageData": {"chartTitles": {"edges": [{"node": node(f"tt{i}{k}", "t", 2000)} for k in range(3)]}}}) if i % 4 else "<p>") for i in range(12)]
    pages(spark, *made).coalesce(1).write.parquet(str(tmp_path / "p"))
    landed = landed_pages(spark, str(tmp_path / "p"))
    found = read_pages(landed.repartition(5, "url"), SITES)
    assert [r.tconst for r in in_input_order(page_rows(found)).collect()] == [f"tt{i}{k}" for i in range(12) if i % 4 for k in range(3)]
    assert [r.url for r in in_input_order(page_rejects(found)).collect()] == [made[i][0] for i in (0, 4, 8)]
