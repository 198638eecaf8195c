"""A whole rebuild from hand-made dumps and pages, against hand-written results."""

from __future__ import annotations

import datetime
import gzip
import shutil
import time
from pathlib import Path
from threading import Barrier

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marquetry.plans.crew import build_crew
from marquetry.plans.gold import COLUMNS, build_gold
from marquetry.plans.refresh import refresh
from marquetry.plans.title import build_title
from marquetry.sources.catalog import register_views
from marquetry.sources.concurrent_jobs import run_together
from marquetry.sources.scratch import release, scratch, scratch_path, scratch_root, stage
from marquetry.sources.tables import data_path, table_path, write_table
from test_pages import SITES, WIKI, node, pages, script, table

N = "\\N"
DUMPS = {
    "title.basics": [
        "tconst titleType primaryTitle originalTitle isAdult startYear endYear runtimeMinutes genres".split(),
        ["tt1", "movie", "Alpha", "Alpha", "0", "1999", N, "100", "Drama"],
        ["tt2", "movie", '"Quoted', '"Quoted', "1", "abc", N, N, N],
        ["tt3", "movie", "Alpha", "Alfa", "0", "1999", N, "90", "Drama"],
        ["tt4", "tvSeries", "Delta", "Delta", N, "2010", "2012", "45", "Crime,Drama"],
        ["tt5", "tvEpisode", "Part", "Part", "0", "2011", N, "30", N],
        ["tt6", "movie", "Zeta", "Zeta", "0", "2001", N, "120", "Comedy"],
        ["tt7", "short", "Eta", "Eta", "0", N, N, "9", "Comedy"],
    ],
    "title.ratings": [
        ["tconst", "averageRating", "numVotes"],
        ["tt1", "8.0", "100"], ["tt3", "7.0", "200"], ["tt4", "9.0", "50"], ["tt6", "6.5", N],
    ],
    "title.crew": [
        ["tconst", "directors", "writers"],
        ["tt1", "nm1,nm2", "nm1"], ["tt3", "nm2", N], ["tt4", N, "nm3"], ["tt6", "nm1", N],
    ],
    "title.principals": [
        "tconst ordering nconst category job characters".split(),
        ["tt1", "1", "nm3", "actor", N, N], ["tt1", "2", "nm3", "actor", N, '["Twin"]'],
        ["tt1", "3", "nm4", "actress", N, N], ["tt1", "4", "nm1", "director", N, N],
        ["tt3", "1", "nm5", "actor", N, N], ["tt6", "1", "nm9", "actor", N, N],
        ["tt4", "1", "nm3", "actor", N, N], ["tt4", "2", "nm6", N, N, N],
    ],
    "name.basics": [
        "nconst primaryName birthYear deathYear primaryProfession knownForTitles".split(),
        ["nm1", "Ann", "1950", N, "director,writer", "tt1,tt3,tt1"],
        ["nm2", "Bob", "1960", N, "director", N],
        ["nm3", "Cid", "1970", "2020", "actor", "tt4,tt99"],
        ["nm4", "Dee", N, N, "actress", "tt7"],
        ["nm5", "Ann", "x", N, "actor", "tt6"],
        ["nm6", "Eve", "1980", N, "producer", "tt1"],
    ],
}

SEARCH = SITES.search


def staged(spark):
    """What lies in the shared folder."""
    folder = Path(scratch_root(spark).removeprefix("file:"))
    return sorted(p.name for p in folder.iterdir()) if folder.exists() else []


def hits(*keys):
    items = [{"titleId": k, "titleText": k, "releaseYear": 2000} for k in keys]
    return script({"searchResults": {"titleResults": {"titleListItems": items}}})


def chart(*ranked):
    edges = [{"currentRank": r, "node": node(k, "t", 2000)} for k, r in ranked]
    return script({"pageData": {"chartTitles": {"edges": edges}}})


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    for name, rows in DUMPS.items():
        with gzip.open(raw / f"{name}.tsv.gz", "wt") as out:
            out.writelines("\t".join(r) + "\n" for r in rows)
    items = {"cmsContext": {"transformedPlacements": {"center-3": {"transformedArguments": {"items": [{"item": node("tt6", "Z", 2001)}]}}}}}
    lists = pages(
        spark,
        ("https://lists.example/chart/top/", chart(("tt1", 1), ("tt3", 2), (None, 3))),
        ("https://lists.example/chart/toptv/", chart(("tt4", 1))),
        ("https://lists.example/india/top-rated-malayalam-movies/", script(items)),
        (f"{SEARCH}?primary_language=ta&sort=num_votes,desc", hits("tt6", "tt1")),
        (f"{SEARCH}?release_date=,9999-12-31&moviemeter=51,100", hits("tt6", "tt7")),
        (f"{SEARCH}?release_date=1900-01-01,1940-12-31&groups=top_1000", hits("tt6")),
        ("https://lists.example/chart/broken/", "<html></html>"),
    )

    def on_chart(gross):
        return table(["1", "<a href='/title/tt6/'>Zeta</a>", gross, "", "", "", "", "2001"])

    revenue = pages(
        spark,
        (f"{SITES.revenue_year}1999", table(["1", "Alpha", "$1,000"], ["2", "Alpha", "$900"])),
        (f"{SITES.revenue_year}2001", table(["1", "Zeta", "$500"])),
        (f"{SITES.revenue_chart}0", on_chart("$500")),
        (f"{SITES.revenue_chart}200", on_chart("$450")),
    )
    root = str(tmp_path_factory.mktemp("lake"))
    day = datetime.date(2024, 5, 17)
    before = staged(spark)
    tables = refresh(spark, root, str(raw), lists, revenue, pages(spark, ("w", WIKI)), SITES, day, partitions=2)
    assert staged(spark) == before
    return root, tables


def rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_bronze(built):
    _, tables = built
    basics = tables["t_title_basics"]
    assert dict(basics.dtypes)["isAdult"] == "tinyint" and dict(basics.dtypes)["genres"] == "string"
    assert rows(basics.filter("tconst = 'tt2'"), "primaryTitle", "startYear", "isAdult") == {('"Quoted', None, 1)}
    assert basics.count() == 7


def test_title(built):
    _, tables = built
    assert rows(tables["t_title"], "tconst", "release_year", "is_adult", "avg_rating", "num_votes") == {
        ("tt1", 1999, "N", 8.0, 100), ("tt2", None, "Y", None, None), ("tt3", 1999, "N", 7.0, 200),
        ("tt4", 2010, "N", 9.0, 50), ("tt5", 2011, "N", None, None), ("tt6", 2001, "N", 6.5, None),
        ("tt7", None, "N", None, None),
    }


def test_top_title(built):
    _, tables = built
    top = tables["t_top_title"]
    assert len(top.columns) == 14
    assert rows(
        top, "tconst", "language_lst", "top_title_rnk", "popularity_rnk", "language_votes_rnk",
        "top_250_movie_rnk", "top_250_tv_rnk", "top_malayalam_movie_rnk", "is_top_1000_movie", "is_top_title",
    ) == {
        ("tt1", "Tamil", 1, None, 2, 1, None, None, "N", "Y"),
        ("tt3", None, 2, None, None, 2, None, None, "N", "Y"),
        ("tt4", None, 1, None, None, None, 1, None, "N", "Y"),
        ("tt6", "Malayalam; Tamil", 1, 51, 1, None, None, 1, "Y", "Y"),
        ("tt7", None, None, 52, None, None, None, None, "N", "N"),
    }


def test_boxoffice(built):
    _, tables = built
    assert rows(tables["t_boxoffice"], "tconst", "box_office") == {("tt3", 1000), ("tt6", 500)}


CREW = {
    ("tt1", "director", "Ann", 1950, "Alpha (1999)"),
    ("tt1", "writer", "Ann", 1950, "Alpha (1999)"),
    ("tt1", "actor", "Cid", 1970, "Delta (2010)"),
    ("tt1", "actress", "Dee", None, None),
    ("tt3", "actor", "Ann", None, "Zeta (2001)"),
    ("tt4", "writer", "Cid", 1970, "Delta (2010)"),
    ("tt4", "actor", "Cid", 1970, "Delta (2010)"),
    ("tt6", "director", "Ann", 1950, "Alpha (1999)"),
}


def test_crew(built):
    _, tables = built
    crew = tables["t_crew"]
    columns = ["tconst", "category", "name", "birth_year", "known_for_titles"]
    assert rows(crew, *columns) == CREW and crew.count() == len(CREW)
    bronze = [tables[f"t_{t}"] for t in ("title_crew", "title_principals", "name_basics", "title_basics")]
    # The second credit of nm3 on tt1 comes back, and so do both credits of nm2.
    assert build_crew(*bronze, dedupe=False).count() == len(CREW) + 1
    everyone = build_crew(*bronze, keep_without_titles=True)
    assert rows(everyone, *columns) - CREW == {
        ("tt1", "director", "Bob", 1960, None), ("tt3", "director", "Bob", 1960, None),
    }


def test_gold(built):
    root, tables = built
    gold = tables["t_catalogue"]
    assert gold.columns == COLUMNS and len(COLUMNS) == 26
    assert rows(
        gold, "tconst", "director_lst", "actor_lst", "actress_lst", "box_office", "top_title_rnk",
        "overall_popularity_rnk", "top_250_movie_rnk", "is_top_title",
    ) == {
        ("tt1", "Ann", "Cid", "Dee", None, 1, 3, 1, "Y"),
        ("tt2", None, None, None, None, 9999, 6, 9999, "N"),
        ("tt3", None, "Ann", None, 1000, 2, 5, 2, "Y"),
        ("tt4", None, "Cid", None, None, 3, 4, 9999, "Y"),
        ("tt6", "Ann", None, None, 500, 4, 1, 9999, "Y"),
        ("tt7", None, None, None, None, 9999, 2, 9999, "N"),
    }
    assert rows(gold, "last_refresh_date") == {(datetime.date(2024, 5, 17),)}


@pytest.mark.parametrize("width", [1, 32])
def test_gold_does_not_depend_on_the_partitioning(spark, built, width):
    _, tables = built
    silver = [tables[t].repartition(5) for t in ("t_title", "t_crew", "t_top_title", "t_boxoffice")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        again = build_gold(*silver, datetime.date(2024, 5, 17))
        assert rows(again, *COLUMNS) == rows(tables["t_catalogue"], *COLUMNS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rejects_and_views(built, spark):
    root, tables = built
    assert rows(tables["rejected_pages"], "url", "reason") == {
        ("https://lists.example/chart/broken/", "no embedded data")
    }
    views = rows(register_views(spark, root), "schema", "table")
    assert {("bronze", "t_name_basics"), ("silver", "t_crew"), ("gold", "t_catalogue")} <= views
    assert not any(s.startswith("_") for s, _ in views)
    found = spark.sql("SELECT count(*) FROM gold.t_catalogue JOIN silver.t_title USING (tconst)").first()[0]
    assert found == 6
    only = register_views(spark, root, schema="silver", table="t_title")
    assert rows(only, "schema", "table") == {("silver", "t_title")}


def test_chart_rank_beyond_the_default(spark, built):
    """A listed title whose only chart rank is above 9999 ranks after all unlisted ones."""
    _, tables = built
    top = tables["t_top_title"].withColumn(
        "top_250_tv_rnk", F.when(F.col("tconst") == "tt4", F.lit(12_000).cast("bigint")).otherwise(F.col("top_250_tv_rnk"))
    )
    gold = build_gold(tables["t_title"], tables["t_crew"], top, tables["t_boxoffice"])
    # tt1 and tt3 lead by chart, then tt6, then the two unlisted titles, then tt4.
    assert rows(gold, "tconst", "top_title_rnk") == {
        ("tt1", 1), ("tt3", 2), ("tt6", 3), ("tt2", 9999), ("tt7", 9999), ("tt4", 6),
    }


def test_equal_titles_rank_by_id(spark):
    basics = spark.createDataFrame(
        [(f"tt{i}", "movie", "Same", "Same", 0, 2000, 90, "Drama") for i in (3, 1, 2)],
        "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult int, "
        "startYear bigint, runtimeMinutes bigint, genres string",
    )
    none = spark.createDataFrame([], "tconst string, averageRating double, numVotes bigint")
    top = spark.createDataFrame(
        [], "tconst string, language_lst string, " + ", ".join(f"{c} bigint" for c in COLUMNS if c.endswith("_rnk") and c != "overall_popularity_rnk")
        + ", popularity_rnk bigint, language_popularity_rnk bigint, language_votes_rnk bigint, is_top_1000_movie string, is_top_title string",
    )
    crew = spark.createDataFrame([], "tconst string, category string, name string")
    box = spark.createDataFrame([], "tconst string, box_office bigint")
    gold = build_gold(build_title(basics, none), crew, top, box)
    assert rows(gold, "tconst", "overall_popularity_rnk", "top_title_rnk") == {("tt1", 1, 9999), ("tt2", 2, 9999), ("tt3", 3, 9999)}


def test_runs_own_what_they_stage(spark):
    """Two overlapping runs: the end of one leaves the tables of the other."""
    start, middle = Barrier(2), Barrier(2)

    def run(first):
        with scratch(spark):
            start.wait(60)
            own = stage(spark.range(5), "own")
            middle.wait(60)
            if first:
                return own.count()
        return None

    def last():
        with scratch(spark):
            start.wait(60)
            own = run_together(spark, {"x": lambda: stage(spark.range(7), "own")}, 1)["x"]
            middle.wait(60)
            for _ in range(200):  # until the other run is over
                if len([n for n in staged(spark) if n.startswith("own-")]) == 1:
                    break
                time.sleep(0.05)
            return own.count()

    before = staged(spark)
    got = run_together(spark, {"a": lambda: run(True), "b": last}, 2)
    assert got == {"a": 5, "b": 7} and staged(spark) == before


def test_a_failed_refresh_leaves_no_folder(spark, built, tmp_path):
    before = staged(spark)
    missing = pages(spark, ("x", "y"))
    with pytest.raises(Exception):  # noqa: B017
        refresh(spark, str(tmp_path / "lake"), str(tmp_path / "none"), missing, missing, missing, SITES)
    assert staged(spark) == before


def test_a_failed_write_leaves_no_folder(spark, tmp_path):
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception):  # noqa: B017
        write_table(broken, str(tmp_path), "silver", "t")
    assert not list((tmp_path / "Tables" / "silver" / "t" / "_data").glob("*"))


def test_release_is_for_what_no_run_owns(spark):
    path = scratch_path(spark, "loose")
    spark.range(1).write.parquet(path)
    release(spark)
    assert not Path(path.removeprefix("file:")).exists()


def test_row_groups(spark, tmp_path):
    rows = spark.range(0, 100_000, 1, 1).withColumn("x", F.col("id") * 7)
    write_table(rows, str(tmp_path), "silver", "t", max_rows_per_group=30_000)
    files = list(Path(data_path(spark, table_path(str(tmp_path), "silver", "t"))).glob("*.parquet"))
    meta = [pq.ParquetFile(f).metadata for f in files]
    groups = [m.row_group(i).num_rows for m in meta for i in range(m.num_row_groups)]
    assert sum(groups) == 100_000 and max(groups) <= 30_000
    write_table(rows, str(tmp_path), "silver", "u", row_group_bytes=100_000)
    files = list(Path(data_path(spark, table_path(str(tmp_path), "silver", "u"))).glob("*.parquet"))
    assert sum(pq.ParquetFile(f).metadata.num_row_groups for f in files) > 1


def test_views_per_root(spark, tmp_path):
    for root, n in (("one", 3), ("two", 5)):
        write_table(spark.range(n), str(tmp_path / root), "silver", "t_views")
        register_views(spark, str(tmp_path / root), schema="silver", prefix=f"{root}_")
    assert spark.table("one_silver.t_views").count() == 3 and spark.table("two_silver.t_views").count() == 5
    shutil.rmtree(tmp_path / "one" / "Tables" / "silver" / "t_views")
    register_views(spark, str(tmp_path / "one"), schema="silver", prefix="one_")
    assert not spark.catalog.tableExists("one_silver.t_views")
