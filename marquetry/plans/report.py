"""Report questions: slicers, their combined filter, bar chart and card."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stage
from .model import measures, pick

# What the report page slices by and shows.
VALUE_SLICERS = ["Release Year"]
TEXT_SLICERS = ["Primary Title", "Generes", "Actors", "Actresses", "Directors", "Languages"]
BAR_BY = "Title Type"
BAR_MEASURES = ["Title #"]
CARD_MEASURES = ["Title #", "Avg Rating", "Data as of"]

SLICERS = [*VALUE_SLICERS, *TEXT_SLICERS]
#: Names of the visuals in :func:`page_summary`.
BAR, CARD = "bar", "card"


def slicer_name(column: str) -> str:
    return f"slicer: {column}"


def slicer_test(column: str, values: Mapping[str, Iterable] | None, texts: Mapping[str, str] | None) -> Column | None:
    """The condition that one slicer sets, None if it is open."""
    chosen, typed = list((values or {}).get(column) or []), (texts or {}).get(column)
    tests = [F.col(column).isin(chosen)] if chosen else []
    if typed:
        tests.append(F.contains(F.col(column), F.lit(typed)))
    return tests[0] & tests[1] if len(tests) == 2 else tests[0] if tests else None


def filter_context(
    values: Mapping[str, Iterable] | None = None, texts: Mapping[str, str] | None = None
) -> Column:
    """All slicers AND-ed: chosen values per column, typed text per column.

    Text matches as a case-sensitive substring. A slicer without choice is open.
    """
    context = F.lit(True)
    for column in dict.fromkeys([*(values or {}), *(texts or {})]):
        test = slicer_test(column, values, texts)
        context = context if test is None else context & test
    return context


def summarize(
    df: DataFrame,
    by: list[str],
    shown: list[str],
    filters: Column | None = None,
    order: str | None = None,
    catalog: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Measures per group under a filter, largest ``order`` first."""
    kept = df if filters is None else df.filter(filters)
    result = kept.groupBy(*by).agg(*pick(catalog or measures(), shown))
    return result.orderBy(F.col(order).desc_nulls_last(), *by) if order else result


def slicer_values(df: DataFrame, column: str, filters: Column | None = None) -> DataFrame:
    """Values a slicer offers, largest first."""
    kept = df if filters is None else df.filter(filters)
    return kept.select(column).distinct().orderBy(F.col(column).desc_nulls_last())


def key_field(kind: str) -> str:
    return f"_key_{''.join(c if c.isalnum() else '_' for c in kind)}"


def page_summary(
    model: DataFrame,
    values: Mapping[str, Iterable] | None = None,
    texts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Everything that the page shows, in one scan, one expansion and one aggregate.

    A row knows by a mask which slicers it fails. With none it counts for the bar, the
    card and every slicer's list; failing one, it only counts for that slicer's own
    list; failing more, for nothing and is dropped before the expansion. What is set on
    columns that are no slicers of the page filters all. One result row per ``visual``
    and key, with all measures; the key is in the field of its type
    (:func:`key_field`), the others are null. Rows of a group combine map-side.
    """
    kinds = dict(model.dtypes)
    known = set(SLICERS)
    outside = filter_context(
        {c: v for c, v in (values or {}).items() if c not in known},
        {c: t for c, t in (texts or {}).items() if c not in known},
    )
    mask = F.lit(0)
    for place, column in enumerate(SLICERS):
        test = slicer_test(column, values, texts)
        if test is not None:
            mask = mask + F.when(F.coalesce(test, F.lit(False)), 0).otherwise(1 << place)
    fields = {key_field(kinds[c]): kinds[c] for c in [*SLICERS, BAR_BY]}

    def entry(visual: str, column: str | None) -> Column:
        own = key_field(kinds[column]) if column else None
        keys = [F.col(f"`{column}`").alias(f) if f == own else F.lit(None).cast(k).alias(f) for f, k in fields.items()]
        return F.struct(F.lit(visual).alias("visual"), *keys)

    lists = [
        F.when(F.col("_fails").isin(0, 1 << place), entry(slicer_name(column), column))
        for place, column in enumerate(SLICERS)
    ]
    shown = [F.when(F.col("_fails") == 0, e) for e in (entry(BAR, BAR_BY), entry(CARD, None))]
    used = list(dict.fromkeys([*SLICERS, BAR_BY, "avg_rating", "last_refresh_date"]))
    one_or_none = [0, *[1 << place for place in range(len(SLICERS))]]
    marked = model.filter(outside).select(*[F.col(f"`{c}`") for c in used], mask.alias("_fails")).filter(F.col("_fails").isin(one_or_none))
    entries = marked.select("avg_rating", "last_refresh_date", F.inline(F.array_compact(F.array(*lists, *shown))))
    names = list(dict.fromkeys([*BAR_MEASURES, *CARD_MEASURES]))
    return entries.groupBy("visual", *fields).agg(*pick(measures(), names))


def overview(
    model: DataFrame,
    values: Mapping[str, Iterable] | None = None,
    texts: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The report page: slicer lists, bar chart and card under one filter.

    A slicer filters all others but not its own list, so another choice stays open.
    The model is read once (:func:`page_summary`) and the summary staged, one row per
    value that is offered; each visual is a filter on that.
    """
    kinds = dict(model.dtypes)
    page = stage(page_summary(model, values, texts), "page")

    def visual(name: str, column: str) -> DataFrame:
        return page.filter(F.col("visual") == name).withColumn("_key", F.col(key_field(kinds[column])))

    shown = {}
    for column in SLICERS:
        offered = visual(slicer_name(column), column).select(F.col("_key").alias(column))
        shown[slicer_name(column)] = offered.orderBy(F.col(column).desc_nulls_last())
    bar = visual(BAR, BAR_BY).select(F.col("_key").alias(BAR_BY), *BAR_MEASURES)
    shown[BAR] = bar.orderBy(F.col(BAR_MEASURES[0]).desc_nulls_last(), BAR_BY)
    # One row, also where nothing passes the filter.
    shown[CARD] = page.filter(F.col("visual") == CARD).agg(
        *[F.coalesce(F.max(m), F.lit(0)).alias(m) if m == "Title #" else F.max(m).alias(m) for m in CARD_MEASURES]
    )
    return shown
