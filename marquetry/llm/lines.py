"""Removal of boilerplate: lines that stand on many sites."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.sources.scratch import stage

from .common import row_key, whole_row

#: Standard error of a sketch with 2^p registers is this over the root of 2^p.
SKETCH_ERROR = 1.04


def line_rows(docs: DataFrame) -> DataFrame:
    """One narrow row per line that has a word: row key, id, site, position, line hash."""
    exploded = docs.select("_k1", "_k2", "_id", "_site", F.posexplode(F.split("_text", "\n")).alias("_at", "_line"))
    return exploded.filter(F.col("_line").rlike(r"[^\x20\x09-\x0D]")).select(
        "_k1",
        "_k2",
        "_id",
        "_site",
        "_at",
        F.xxhash64("_line").alias("_h1"),
        F.xxhash64(F.lit(7), "_line").alias("_h2"),
    )


def wide_spread_lines(lines: DataFrame, min_sites: int, registers_log2: int) -> DataFrame:
    """Hashes of the lines on ``min_sites`` sites or more, and where each stands first.

    One sketch of sites per line hash, merged by aggregation. An estimate further
    than four standard errors from the threshold decides; the lines nearer to it,
    and only they, get exact counts of distinct sites.
    """
    margin = 1 + 4 * SKETCH_ERROR / math.sqrt(2**registers_log2) * min_sites
    sketches = lines.groupBy("_h1", "_h2").agg(
        F.hll_sketch_agg("_site", registers_log2).alias("_sketch"),
        F.min(F.struct("_id", "_at")).alias("_first"),
    )
    spread = stage(
        sketches.select("_h1", "_h2", "_first", F.hll_sketch_estimate("_sketch").alias("_sites")).filter(
            F.col("_sites") >= min_sites - margin
        ),
        "line-spread",
    )
    near = spread.filter(F.col("_sites") <= min_sites + margin)
    exact = (
        lines.filter(F.col("_site").isNotNull())
        .join(near.select("_h1", "_h2"), ["_h1", "_h2"], "left_semi")
        .select("_h1", "_h2", "_site")
        .distinct()
        .groupBy("_h1", "_h2")
        .agg(F.count("_site").alias("_exact"))
        .filter(F.col("_exact") >= min_sites)
    )
    counted = near.join(exact, ["_h1", "_h2"]).select("_h1", "_h2", "_first")
    clear = spread.filter(F.col("_sites") > min_sites + margin).select("_h1", "_h2", "_first")
    return stage(clear.unionByName(counted), "line-boilerplate")


def strip_boilerplate(
    docs: DataFrame,
    min_sites: int = 10,
    registers_log2: int = 12,
    text: str = "text",
    site: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Remove lines that stand on ``min_sites`` distinct sites or more, but for the first.

    Returns per input row ``row`` (all columns as a struct, unchanged), ``text``
    without those lines, ``n_lines`` (lines with a word) and ``n_removed``. The first
    occurrence, by id (nulls first) and position, stays, so a text copied to many
    sites is not lost as a whole. Lines are compared exactly as they are; lines
    without a word are neither counted nor removed. A null site is no site, but its
    rows are cleaned. A null text stays null with 0 lines. Repeated rows are treated
    alike and all stay. An empty table gives no rows, and columns may have any names.
    """
    rows = docs.select(
        whole_row(docs).alias("row"),
        F.col(text).alias("_text"),
        F.col(site).cast("string").alias("_site"),
        F.col(doc_id).alias("_id"),
    ).select("*", *row_key(F.col("_id"), F.col("_text")))
    lines = line_rows(rows.drop("row"))
    boilerplate = wide_spread_lines(lines, min_sites, registers_log2)
    removed = (
        lines.join(boilerplate, ["_h1", "_h2"])
        .filter(~F.struct("_id", "_at").eqNullSafe(F.col("_first")))
        .groupBy("_k1", "_k2")
        .agg(F.collect_set("_at").alias("_removed"))
    )
    joined = rows.join(removed, ["_k1", "_k2"], "left")
    all_lines = F.split("_text", "\n")

    def stays(_: Column, at: Column) -> Column:
        return ~F.array_contains(F.col("_removed"), at)

    cleaned = F.when(F.col("_removed").isNull(), F.col("_text")).otherwise(
        F.array_join(F.filter(all_lines, stays), "\n")
    )
    with_word = F.size(F.filter(all_lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    return joined.select(
        "row",
        cleaned.alias("text"),
        F.when(F.col("_text").isNull(), 0).otherwise(with_word).cast("long").alias("n_lines"),
        F.coalesce(F.array_size("_removed"), F.lit(0)).cast("long").alias("n_removed"),
    )


def cleaned_documents(docs: DataFrame, text: str = "text", length: str = "n_chars", **options) -> DataFrame:
    """``docs`` with cleaned texts, and the code points of the text in ``length`` if there is such a column.

    All rows stay, also those whose text is empty afterwards; other columns are unchanged.
    """
    cleaned = strip_boilerplate(docs, text=text, **options)
    out = cleaned.withColumnRenamed("text", "_cleaned").drop("n_lines", "n_removed")
    columns = []
    for name in docs.columns:
        column = F.col("row").getField(name)
        if name == text:
            column = F.col("_cleaned")
        elif name == length:
            column = F.length("_cleaned").cast(docs.schema[name].dataType)
        columns.append(column.alias(name))
    return out.select(*columns)
