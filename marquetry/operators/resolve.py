"""Give rows that carry only a name an id, unless an id row already covers them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import anti_join
from .rank import top1_per_group


def resolve_entities(
    with_id: DataFrame,
    without_id: DataFrame,
    entities: DataFrame,
    key: str,
    on: Sequence[str],
    value: str,
    prefer: Column,
) -> DataFrame:
    """(key, value) of the name rows that resolve to an entity.

    An entity that has an id row is taken, and a name row equal to an id row in
    ``on`` and ``value`` is a copy of it; both drop out. Per ``on`` group one pair
    remains: the entity first by ``prefer``, with the largest value. Which entity
    wins does not depend on the name row and the other way round, so each side is
    reduced to one row per group before they meet and no pairs are built.
    """
    on = list(on)
    best = top1_per_group(
        anti_join(entities.select(key, *on, prefer.alias("_prefer")), with_id, [key]),
        on,
        [F.col("_prefer").desc_nulls_last(), F.col(key).asc()],
    )
    triple = [*on, value]
    # One row per key on both sides, so no key can be hot.
    copies = with_id.select(*triple).distinct()
    new = without_id.select(*triple).distinct().join(copies, triple, "left_anti")
    named = new.groupBy(*on).agg(F.max(value).alias(value))
    return named.join(best, on).select(key, value)
