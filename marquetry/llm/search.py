"""Ranked lexical search: documents are grouped by the mask of an item's terms that they hold."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquetry.operators.rank import dist_row_number
from marquetry.sources.scratch import stage

#: A term is a longest run of digits, ASCII letters and all characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Bytes that end a term become spaces, A-Z become lower case, all others stay.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

#: (item, term) rows whose terms are broadcast at a time; a block has at most one item more.
BLOCK_TERMS = 100_000

#: Documents of a segment, the bitmaps' length; terms of one mask word.
SEGMENT_DOCS, WORD_TERMS = 4096, 64

#: Documents that are scored at least, before a mask's bound is held against the results again.
WAVE_DOCS = 64


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of_items(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The items with a key ``_q`` of each row, and their distinct terms with ``block`` and ``repeats``."""
    named = items.select(F.monotonically_increasing_id().alias("_q"), F.col(item_id).alias("item_id"), F.col(text).alias("_text"))
    named = stage(named, "items")
    found = named.select("_q", F.explode(F.regexp_extract_all(lower_ascii(F.col("_text")), F.lit(TERM), F.lit(0))).alias("term"))
    terms = stage(found.groupBy("_q", "term").agg(F.count(F.lit(1)).alias("repeats")), "item-terms")
    numbered = dist_row_number(terms, [F.col("_q"), F.col("term")], "at")
    first = numbered.groupBy("_q").agg(F.floor((F.min("at") - 1) / F.lit(BLOCK_TERMS)).alias("block"))
    return named.select("_q", "item_id"), stage(terms.join(first, "_q"), "item-blocks")


def count_terms(docs: DataFrame, known: Broadcast) -> DataFrame:
    """``doc_id``, its number of terms ``n``, and the numbers and counts of its ``known`` terms."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n bigint, terms array<int>, counts array<bigint>"
    names = StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            totals, terms, counts, ends = [], [], [], [0]
            for value in batch.column(1):
                words = (value.as_py() or "").encode().translate(FOLD).split()
                totals.append(len(words))
                for word, count in Counter(words).items():
                    at = number.get(word)
                    if at is not None:
                        terms.append(at)
                        counts.append(count)
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x) for x in (pa.array(terms, pa.int32()), pa.array(counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), *lists], names=names)

    return docs.select("doc_id", "_text").mapInArrow(run, schema)


class Segment:
    """The postings of some documents: a bitmap, counts and the largest share in a score for each term."""

    def __init__(self, batch: pa.Table, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.ids = batch.column("doc_id").combine_chunks()
        self.size = len(self.ids)
        places = pc.sort_indices(self.ids, sort_keys=[("", "ascending")], null_placement="at_end").to_numpy()
        self.id_rank = np.empty(self.size, np.int64)
        self.id_rank[places] = np.arange(self.size)
        lengths = batch.column("n").to_numpy()
        listed, counted = (batch.column(c).combine_chunks() for c in ("terms", "counts"))
        held = np.diff(listed.offsets.to_numpy())
        docs, tf = np.repeat(np.arange(self.size), held), counted.flatten().to_numpy()
        terms = listed.flatten().to_numpy()
        damp = 75 + (25 * lengths * n_docs) // max(n_terms, 1)
        worth = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 12 * damp[docs]))
        order = np.argsort(terms, kind="stable")
        self.docs, self.worth = docs[order], worth[order]
        present, first = np.unique(terms[order], return_index=True)
        self.bounds = np.append(first, len(order))
        self.row = {t: i for i, t in enumerate(present.tolist())}
        self.most = np.maximum.reduceat(self.worth, first) if len(first) else np.zeros(0, np.int64)
        self.bitmaps = np.empty((len(present), -(-self.size // 8)), np.uint8)
        for start in range(0, len(present), 1024):
            end = min(start + 1024, len(present))
            dense = np.zeros((end - start, self.size), bool)
            part = slice(self.bounds[start], self.bounds[end])
            lines = np.repeat(np.arange(end - start), np.diff(self.bounds[start : end + 1]))
            dense[lines, self.docs[part]] = True
            self.bitmaps[start:end] = np.packbits(dense, axis=1)

    def masks(self, rows: np.ndarray, gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each document's group of equal term masks, and the largest score that a group's mask allows."""
        group, bound = np.zeros(self.size, np.int64), np.zeros(1, np.int64)
        for start in range(0, len(rows), WORD_TERMS):
            part = rows[start : start + WORD_TERMS]
            bits = np.unpackbits(self.bitmaps[part], axis=1, count=self.size)
            bytes_ = np.zeros((self.size, 8), np.uint8)
            bytes_[:, : -(-len(part) // 8)] = np.packbits(bits, axis=0).T
            values, word = np.unique(bytes_.view(np.uint64).ravel(), return_inverse=True)
            _, first, merged = np.unique(group * len(values) + word, return_index=True, return_inverse=True)
            bound = bound[group[first]] + gain[start : start + WORD_TERMS] @ bits[:, first].astype(np.int64)
            group = merged
        return group, bound

    def scores(self, chosen: np.ndarray, rows: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """The scores of the documents ``chosen``, which are in ascending order."""
        total = np.zeros(len(chosen), np.int64)
        for row, times in zip(rows.tolist(), repeats.tolist()):
            part = slice(self.bounds[row], self.bounds[row + 1])
            held = self.docs[part]
            at = np.minimum(np.searchsorted(held, chosen), len(held) - 1)
            total += np.where(held[at] == chosen, self.worth[part][at], 0) * times
        return total

    def improve(self, best: list[tuple], terms: list[int], repeats: list[int], top: int) -> list[tuple]:
        """``best`` with this segment's documents, as (-score, id is null, id), at most ``top``.

        Masks are taken by descending bound; when the next bound is below the
        ``top``-th score found so far, no document left can be among the best. An
        equal bound goes on, as an equal score may have a smaller id.
        """
        pairs = [(self.row[t], r) for t, r in zip(terms, repeats) if t in self.row]
        if not pairs:
            return best
        rows, times = (np.array(x, np.int64) for x in zip(*pairs))
        group, bound = self.masks(rows, self.most[rows] * times)
        by_bound = np.argsort(-bound, kind="stable")
        place = np.empty(len(bound), np.int64)
        place[by_bound] = np.arange(len(bound))
        docs = np.argsort(place[group], kind="stable")
        ends = np.cumsum(np.bincount(place[group], minlength=len(bound)))
        done, wave = 0, WAVE_DOCS
        while done < len(bound):
            least = max(1, -best[-1][0] if len(best) == top else 1)
            if bound[by_bound[done]] < least:
                break
            start = ends[done - 1] if done else 0
            done = min(int(np.searchsorted(ends, start + wave)) + 1, len(bound))
            wave *= 2
            chosen = np.sort(docs[start : ends[done - 1]])
            score = self.scores(chosen, rows, times)
            good = score >= least
            chosen, score = chosen[good], score[good]
            first = np.lexsort((self.id_rank[chosen], -score))[:top]
            new = [(-s, i is None, i) for s, i in zip(score[first].tolist(), self.ids.take(pa.array(chosen[first])).to_pylist())]
            best = sorted(best + new, key=lambda x: (x[0], x[1], x[2] if not x[1] else 0))[:top]
        return best


def rank_block(postings: DataFrame, items: Broadcast, weights: Broadcast, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """``_q``, ``doc_id`` and ``score`` of each task's best documents for each item of the block."""
    kind = postings.schema["doc_id"].dataType.simpleString()
    schema = f"_q bigint, doc_id {kind}, score bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for start in range(0, batch.num_rows, SEGMENT_DOCS):
                segment = Segment(pa.Table.from_batches([batch.slice(start, SEGMENT_DOCS)]), weights.value, n_docs, n_terms)
                for q, terms, repeats in items.value:
                    best[q] = segment.improve(best.get(q, []), terms, repeats, top)
        rows = [(q, i, -s) for q, found in best.items() for s, _, i in found]
        if rows:
            qs, ids, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(qs, pa.int64()), pa.array(ids, id_type), pa.array(scores, pa.int64())], names=["_q", "doc_id", "score"])

    return postings.filter(F.size("terms") > 0).mapInArrow(run, schema)


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = 20,
) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank (from 1), doc_id, score (above 0).

    One scan finds the items' terms in all whole texts; their counts are staged,
    with the number of terms, and give the weights. Then each task groups its
    segments' documents, per item, by the mask of the item's terms that they hold
    (rows of the terms' bitmaps turned into one word per document), bounds each
    distinct mask by the largest share that each of its terms has in the segment,
    and scores the masks' documents by descending bound until no bound reaches the
    ``top``-th score. At most ``top`` rows per item and task meet in the end.

    Items come in blocks of about ``BLOCK_TERMS`` terms, which bounds what is
    broadcast; each block scans the documents. Every row is a document of its own
    and every item row an item: repeated rows repeat. A null or empty text has no
    term: such documents are never found and such items give no rows. Equal scores
    go by ascending doc_id, null last. A very long text is one row of counts. Empty
    tables give no rows; no other column is read, so extra names do no harm.
    """
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    named, terms = terms_of_items(items, item_id, item_text)
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    found = None
    for (block,) in sorted(terms.select("block").distinct().collect()):
        # Bounded: BLOCK_TERMS rows and one item's terms.
        rows = terms.filter(F.col("block") == block).select("_q", "term", "repeats").collect()
        numbers = {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
        asked: dict[int, tuple[list[int], list[int]]] = {}
        for q, term, repeats in sorted(rows):
            own = asked.setdefault(q, ([], []))
            own[0].append(numbers[term])
            own[1].append(repeats)
        postings = stage(count_terms(picked, share({t.encode(): i for t, i in numbers.items()})), "postings")
        n_docs, n_terms = postings.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
        weights = np.zeros(len(numbers), np.int64)
        for term, value in held.select("term", weight).collect():
            weights[term] = value
        own = [(q, *lists) for q, lists in asked.items()]
        part = rank_block(postings, share(own), share(weights), n_docs, n_terms, top)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = picked.select(F.lit(0).cast("long").alias("_q"), "doc_id", F.lit(0).cast("long").alias("score")).limit(0)
    best = Window.partitionBy("_q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(named, "_q").select("item_id", "rank", "doc_id", "score")
