"""Near copies by SimHash, found with one-wildcard variants of fingerprint segments."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.sources.scratch import stage

from .common import map_texts, row_key, unpack, whole_row
from .components import components

#: Words of a shingle, seed of the hash, bits by which linked fingerprints may differ.
SHINGLE, SEED, RADIUS = 4, 42, 4
#: First bit and width of the segments. Of three segments that differ by 4 bits
#: together, one differs by 1 bit at most.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Members of a band that all its members are compared with at first, and links kept of a member there.
PIVOTS, LINKS = 12, 3


def simhashes(texts: list[str]) -> list[np.ndarray]:
    """One fingerprint per text, as the signed form of 64 bits."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.encode().lower().split()
        if not words:
            continue
        if len(words) < SHINGLE:
            hashes.append(digest(b" ".join(words), SEED))
            counts[i] = 1
            continue
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-SHINGLE].tolist()]
        hashes += [digest(line[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist())]
        counts[i] = len(starts)
    prints = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        all_hashes = np.array(hashes, np.uint64)
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        found = np.zeros(len(full), np.uint64)
        for bit in range(64):
            ones = np.add.reduceat(((all_hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), starts)
            found |= (2 * ones > counts[full]).astype(np.uint64) << np.uint64(bit)
        prints[full] = found
    return [prints.view(np.int64)]


def variants(fingerprint: Column) -> Column:
    """64 keys: each segment with each of its bits taken as a wildcard.

    Two fingerprints with a segment that differs by one bit at most share the key
    with the wildcard there. A key also says which bit the wildcard is.
    """
    keys = []
    for first, width in SEGMENTS:
        segment = F.shiftrightunsigned(fingerprint, first)
        for bit in range(width):
            mask = ((1 << width) - 1) & ~(1 << bit)
            keys.append(segment.bitwiseAND(F.lit(mask).cast("long")) + F.lit((first + bit) << 22).cast("long"))
    return F.array(*keys)


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def bands(fingerprint: Column) -> Column:
    """Keys of exact parts of a fingerprint: the segments and four parts of 16 bits."""
    parts = [*SEGMENTS, *[(16 * i, 16) for i in range(4)]]
    return F.array(
        *[
            F.shiftrightunsigned(fingerprint, first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            + F.lit(i << 22).cast("long")
            for i, (first, width) in enumerate(parts)
        ]
    )


def pivot_links(nodes: DataFrame) -> DataFrame:
    """Links between fingerprints and a few pivots that share a band with them.

    The pivots of a band are the fingerprint with the most documents and some picked by
    hash, so the cost is in proportion to the number of fingerprints. A large group of
    near copies is nearly all joined up by this; no link is missed in the end, as the
    variants find what is left.
    """
    rows = nodes.select("fp", "copies", F.explode(bands(F.col("fp"))).alias("band"))
    picks = [F.min_by("fp", F.xxhash64(F.lit(i), "fp")).alias(f"p{i}") for i in range(1, PIVOTS)]
    pivots = rows.groupBy("band").agg(F.max_by("fp", "copies").alias("p0"), *picks, F.count(F.lit(1)).alias("members"))
    met = rows.join(pivots.filter("members > 1").hint("merge"), "band")
    near = F.filter(
        F.array(*[f"p{i}" for i in range(PIVOTS)]),
        lambda p: (p != F.col("fp")) & (distance(p, F.col("fp")) <= RADIUS),
    )
    linked = met.select("fp", F.slice(near, 1, LINKS).alias("linked")).filter(F.size("linked") > 0)
    return linked.select(F.col("fp").alias("a"), F.explode("linked").alias("b"))


def links_of_singles(singles: DataFrame, nodes: DataFrame) -> DataFrame:
    """All links of fingerprints that no pivot was near to."""
    # The planner does not see that a row becomes 64, and would broadcast by the size before.
    asked = singles.select(F.col("fp").alias("a"), F.explode(variants(F.col("fp"))).alias("key")).hint("merge")
    there = nodes.select(F.col("fp").alias("b"), F.explode(variants(F.col("fp"))).alias("key"))
    close = (F.col("a") != F.col("b")) & (distance(F.col("a"), F.col("b")) <= RADIUS)
    return asked.join(there, "key").filter(close).select("a", "b").distinct()


def links_of_groups(grouped: DataFrame) -> DataFrame:
    """Links between members of different groups, as pairs of roots; never inside a group.

    Which groups meet in a bucket is found on one row per bucket and group.
    """
    members = grouped.select("fp", "root", F.explode(variants(F.col("fp"))).alias("key"))
    meeting = members.select("key", "root").distinct()
    pairs = meeting.join(meeting.withColumnRenamed("root", "other").hint("merge"), "key").filter("root < other")
    left = pairs.join(members.withColumnRenamed("fp", "a").hint("merge"), ["key", "root"])
    right = members.select("key", F.col("root").alias("other"), F.col("fp").alias("b"))
    close = distance(F.col("a"), F.col("b")) <= RADIUS
    found = left.join(right.hint("merge"), ["key", "other"]).filter(close)
    return found.select(F.col("root").alias("a"), F.col("other").alias("b")).distinct()


def fingerprint_components(prints: DataFrame) -> DataFrame:
    """``fp``, ``component``: the smallest doc_id among all fingerprints reachable from ``fp``.

    ``prints`` has doc_id and fp. Equal fingerprints are one node from the start. Pivots
    join up the bulk of each group of near copies; then the variants give all links
    of the fingerprints that are left over, and all links between groups. Pairs
    inside a group are never built, and no link between groups is lost.
    """
    nodes = stage(
        prints.groupBy("fp").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("copies")), "prints"
    )
    roots = components(pivot_links(nodes).distinct())
    rooted = roots.select(F.col("a").alias("fp"), "root").unionByName(
        roots.select(F.col("root").alias("fp"), "root").distinct()
    )
    rooted = stage(nodes.join(rooted, "fp", "left"), "rooted")
    singles = rooted.filter("root IS NULL").select("fp")
    grouped = rooted.filter("root IS NOT NULL").select("fp", "root")

    single_links = links_of_singles(singles, nodes)
    # Only the far end of such a link can be in a group.
    towards = single_links.join(grouped.withColumnRenamed("fp", "b"), "b", "left").select(
        "a", F.coalesce("root", "b").alias("b")
    )
    merged = components(towards.unionByName(links_of_groups(grouped)).distinct())

    first = rooted.select("fp", "doc", F.coalesce("root", "fp").alias("first"))
    last = first.join(merged.select(F.col("a").alias("first"), F.col("root").alias("later")), "first", "left")
    last = last.select("fp", "doc", F.coalesce("later", "first").alias("root"))
    smallest = last.groupBy("root").agg(F.min("doc").alias("component"))
    return stage(last.join(smallest, "root").select("fp", "component"), "components")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per input row ``doc_id``, ``fp`` (64 bits, signed), ``component`` (smallest id reachable) and a row key.

    Links are all pairs of fingerprints that differ by 4 bits or less, whatever the
    texts. Null and empty texts have fingerprint zero and are linked like others;
    texts of any length count whole. Null ids are passed over when the smallest id
    is taken; a group of null ids only has a null component. Repeated rows repeat;
    an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    rows = rows.select("doc_id", *row_key(F.col("doc_id"), F.col("_text")), "_text")
    prints = stage(map_texts(rows, ["doc_id", "_k1", "_k2"], "_text", simhashes, "fp bigint"), "simhash")
    return prints.join(fingerprint_components(prints), "fp").select("doc_id", "_k1", "_k2", "fp", "component")


def keep_one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id.

    Ids are compared as they are, nulls last; among rows of one id the smallest row
    key stays, and of rows that are equal in id and text one stays. Columns are
    those of ``docs``, whatever they are called; an empty table stays empty.
    """
    found = near_duplicates(docs, text, doc_id)
    # Rows without any id in their component are one group per fingerprint group.
    ranked = found.withColumn("_at", F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "_k1", "_k2"))
    best = ranked.groupBy("component", F.when(F.col("component").isNull(), F.col("fp")).alias("_null")).agg(
        F.min("_at").alias("_at")
    )
    winners = best.select("_at._k1", "_at._k2")
    rows = docs.select(whole_row(docs).alias("_row"), *row_key(F.col(doc_id), F.col(text)))
    kept = rows.join(winners, ["_k1", "_k2"]).groupBy("_k1", "_k2").agg(F.first("_row").alias("_row"))
    return unpack(kept, docs.columns)
