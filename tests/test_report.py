"""Measures, filters and the report page on a small gold table."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from marquetry.plans.gold import COLUMNS
from marquetry.plans.model import DISPLAY_NAMES, HIDDEN, default_summary, measures, model_projection
from marquetry.plans.report import filter_context, overview, slicer_values, summarize

DAY = datetime.date(2024, 5, 17)


@pytest.fixture(scope="module")
def model(spark):
    shape = {c: "bigint" if c.endswith("_rnk") else "string" for c in COLUMNS}
    shape |= dict(release_year="bigint", runtime_min="bigint", avg_rating="double", num_votes="bigint")
    shape |= dict(box_office="bigint", last_refresh_date="date")
    known = [
        dict(tconst="tt1", title_type="movie", release_year=1999, avg_rating=8.0, num_votes=10, box_office=1_500_000,
             runtime_min=100, is_top_title="Y", director_lst="Ann; Bob", genres="Drama"),
        dict(tconst="tt2", title_type="movie", release_year=2001, avg_rating=6.0, num_votes=5, runtime_min=80,
             is_top_title="N", director_lst="ann", genres="Comedy"),
        dict(tconst="tt3", title_type="short", release_year=None, is_top_title="N", genres="Drama,Comedy"),
    ]
    rows = [tuple((r | {"last_refresh_date": DAY}).get(c) for c in COLUMNS) for r in known]
    return model_projection(spark.createDataFrame(rows, ", ".join(f"{c} {shape[c]}" for c in COLUMNS)), id_label="Key")


def test_projection(model, spark):
    assert len(model.columns) == 26 and set(DISPLAY_NAMES) == set(COLUMNS)
    assert "Key" in model.columns and "Title Type" in model.columns
    shown = model_projection(spark.createDataFrame([], ", ".join(f"{c} string" for c in COLUMNS)), hidden=False)
    assert len(shown.columns) == 21 and not set(HIDDEN) & set(shown.columns)


def test_measures_per_group(model):
    catalog = measures("https://x/title/", "Key")
    got = {r["Title Type"]: r for r in summarize(model, ["Title Type"], list(catalog), catalog=catalog).collect()}
    movie, short = got["movie"], got["short"]
    assert (movie["Avg Rating"], movie["Avg Runtime (mins)"], movie["Title #"]) == (7.0, 90.0, 2)
    assert (movie["Box Office $"], movie["Box Office Label"], movie["Number of Votes"]) == (1_500_000, "$2M", 15)
    assert movie["Title Link"] == "https://x/title//" and short["Title Link"] == "https://x/title/tt3/"
    assert movie["Font Color"] == "Green" and short["Font Color"] is None
    assert short["Avg Rating"] is None and short["Box Office Label"] is None and short["Data as of"] == DAY


def test_link_needs_exactly_one_value(model):
    catalog = measures("p/", "Key")
    twice = model.union(model.filter("Key = 'tt1'")).filter("Key = 'tt1'")
    assert summarize(twice, [], ["Title Link"], catalog=catalog).first()[0] == "p/tt1/"
    blank = model.withColumn("Key", F.when(F.col("Key") == "tt1", F.col("Key")))
    assert summarize(blank, [], ["Title Link"], catalog=catalog).first()[0] == "p//"


def test_filters_are_combined(model):
    both = filter_context({"Release Year": [1999, 2001]}, {"Directors": "Ann"})
    assert [r["Key"] for r in model.filter(both).collect()] == ["tt1"]
    assert model.filter(filter_context({"Release Year": []}, {"Directors": ""})).count() == 3
    assert model.filter(filter_context(texts={"Generes": "Comedy"})).count() == 2


def test_slicer_values_are_sorted(model):
    assert [r[0] for r in slicer_values(model, "Release Year").collect()] == [2001, 1999, None]


def test_page(model):
    page = overview(model, texts={"Generes": "Drama"})
    assert [tuple(r) for r in page["bar"].collect()] == [("movie", 1), ("short", 1)]
    assert tuple(page["card"].first()) == (2, 8.0, DAY)
    assert len([k for k in page if k.startswith("slicer")]) == 7
    assert tuple(overview(model)["bar"].first()) == ("movie", 2)


def test_slicers_filter_each_other(model):
    page = overview(model, {"Release Year": [1999]}, {"Directors": "n"})
    offered = {c: {r[0] for r in page[f"slicer: {c}"].collect()} for c in ("Release Year", "Directors", "Generes")}
    assert offered == {"Release Year": {1999, 2001}, "Directors": {"Ann; Bob"}, "Generes": {"Drama"}}


def test_default_summary(model):
    assert set(default_summary(model.columns)) == {"runtime_min", "avg_rating", "num_votes", "box_office"}
