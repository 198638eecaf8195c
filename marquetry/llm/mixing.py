"""Mix sources to target weights by Poisson replication of documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.sources.scratch import stage

from .common import whole_row


#: Hex digits of the digest that make the uniform number: 52 bits, exact as a double.
DIGITS = 13
#: Rates above are drawn in equal parts of at most as much, as exp(-rate) loses bits from about 708 on.
PART_RATE = 700.0


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the digest of ``parts``, equal wherever it is computed."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") / float(16**DIGITS)


def poisson_steps(rate: Column) -> Column:
    """The distribution function of a Poisson variable with mean ``rate``, up to all but certainty.

    ``uniform`` has 52 bits, and the terms end where the rest is far below one of them.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20)
    start = F.struct(
        F.exp(-rate).alias("term"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps")
    )

    def step(done: Column, k: Column) -> Column:
        term = done["term"] * rate / k
        total = done["sum"] + term
        return F.struct(
            term.alias("term"), total.alias("sum"), F.array_append(done["steps"], total).alias("steps")
        )

    return F.aggregate(F.sequence(F.lit(1).cast("long"), last), start, step, lambda done: done["steps"])


def source_rates(
    docs: DataFrame,
    weights: Mapping[str, float] | None,
    epochs: float,
    source: str,
    text: str,
) -> DataFrame:
    """For each source: its characters, mean repetition ``rate``, the ``parts`` it is drawn in, ``steps`` of a part.

    The rate makes the expected characters of a source its share of ``epochs`` times
    all characters. Without ``weights`` all sources that have text weigh the same;
    with them, sources that they do not name get no document.
    """
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(
        F.coalesce(F.sum(F.length(F.col(text))), F.lit(0)).alias("_chars")
    )
    if weights is None:
        weight = F.when(F.col("_chars") > 0, 1.0).otherwise(0.0)
    else:
        pairs = [F.lit(x) for item in weights.items() for x in (item[0], float(item[1]))]
        given = F.create_map(*pairs) if pairs else F.create_map(F.lit(""), F.lit(0.0))
        weight = F.when(F.col("_chars") > 0, F.coalesce(given[F.col("_source")], F.lit(0.0))).otherwise(0.0)
    weighed = stage(sizes.withColumn("_weight", weight), "mix-sizes")
    totals = weighed.agg(F.sum("_chars").alias("_all"), F.sum("_weight").alias("_weights"))
    rate = F.when(
        F.col("_weight") > 0,
        F.col("_weight") * F.lit(float(epochs)) * F.col("_all") / F.col("_weights") / F.col("_chars"),
    ).otherwise(0.0)
    rated = weighed.crossJoin(F.broadcast(totals)).select("_source", "_chars", rate.alias("_rate"))
    parts = F.greatest(F.ceil(F.col("_rate") / PART_RATE), F.lit(1)).cast("int")
    split = rated.withColumn("_parts", parts)
    return split.withColumn("_steps", poisson_steps(F.col("_rate") / F.col("_parts")))


def poisson_count(seed: int, name: Column, parts: Column, steps: Column) -> Column:
    """The sum of ``parts`` independent draws from the distribution ``steps``, which is Poisson again."""
    first = F.array(uniform(F.lit(str(seed)), name))
    more = F.transform(
        F.sequence(F.lit(2), parts), lambda part: uniform(F.lit(str(seed)), name, F.concat(F.lit("part"), part))
    )
    drawn = F.when(parts > 1, F.concat(first, more)).otherwise(first)
    return F.aggregate(drawn, F.lit(0), lambda done, u: done + F.size(F.filter(steps, lambda s: s <= u)))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    epochs: float = 1.0,
    seed: int = 0,
    source: str = "source",
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Repeat each document so often that the sources meet their target weights, in random order.

    A document is repeated k times, k drawn from the Poisson distribution whose mean
    is the repetition rate of its source, by inverting it at a number hashed from
    seed and document id; a large mean is the sum of draws of equal parts (``PART_RATE``).
    Returns ``row`` (all columns as a struct), ``copy`` from 1,
    and ``order_key``; sorted by it the rows are in a random order that depends on
    seed, id and copy only. They are dealt to partitions by another hash and sorted
    within them, so reading the partitions one after another is a shuffle, too.

    A null source is a source of its own; sources without text, and null weights,
    get no document. Null ids share one draw, as do repeated rows. Empty texts are
    repeated like others of their source. An empty table gives no rows. Columns may
    have any names.
    """
    rates = stage(source_rates(docs, weights, epochs, source, text), "mix-rates")
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    rows = docs.select(
        whole_row(docs).alias("row"), F.col(source).alias("_doc_source"), name.alias("_id")
    )
    count = poisson_count(seed, F.col("_id"), F.col("_parts"), F.col("_steps"))
    # The rates are a staged table of one row per source: its size is known to the
    # planner, which broadcasts it only below the session's threshold.
    counted = rows.join(rates, F.col("_doc_source").eqNullSafe(F.col("_source"))).select(
        "row", "_id", count.alias("_count")
    )
    copies = counted.filter("_count > 0").select(
        "row", "_id", F.explode(F.sequence(F.lit(1), F.col("_count"))).alias("copy")
    )
    keyed = copies.select(
        "row",
        F.col("copy").cast("long").alias("copy"),
        F.md5(F.concat_ws("|", F.lit(f"order{seed}"), "_id", "copy")).alias("order_key"),
    )
    return keyed.repartition(F.xxhash64("order_key")).sortWithinPartitions("order_key")
