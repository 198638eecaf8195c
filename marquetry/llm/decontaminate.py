"""Benchmark passages in documents, by SimHash of windows as long as the items or the text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.sources.scratch import stage

from .common import CHUNK_CHARS, row_key, unpack, whole_row

#: Words of a shingle, and the weighted similarity from which a window is a copy of an item.
SHINGLE, SIMILARITY = 5, 0.8
#: Fingerprints of 64 bits are cut into 4 blocks. Fingerprints within the radius have a
#: block that differs by 4 bits at most, as 4 blocks of 5 bits or more make 20.
BLOCKS, BLOCK_BITS, RADIUS, BLOCK_RADIUS = 4, 16, 19, 4
#: Bits of the filter of benchmark shingles; its size does not depend on the benchmark.
FILTER_BITS = 24
#: Distinct words whose hashes a task remembers.
REMEMBERED = 500_000

WORD = re.compile(r"[^\W_]+")
MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
SHIFT = np.uint64(33)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode(), 1)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> SHIFT)) * MIX_A
    x = (x ^ (x >> SHIFT)) * MIX_B
    return x ^ (x >> SHIFT)


def word_hashes(text: str | None, known: WordHashes) -> np.ndarray:
    """Hashes of the words: runs of letters and digits, in lower case."""
    return np.fromiter(map(known.__getitem__, WORD.findall((text or "").lower())), np.uint64)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mixed(out + words[k : k + n])
    return out


def width_of(size: int) -> int:
    """Items shorter than a shingle are one shingle as a whole."""
    return min(SHINGLE, size)


def fingerprint(hashes: np.ndarray) -> int:
    """SimHash, each shingle weighted by how often it occurs; signed."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    on = (2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)).astype(np.uint8)
    return int(np.packbits(on, bitorder="little").view(np.int64)[0])


def near_blocks(value: int) -> np.ndarray:
    """Each block of a fingerprint with up to ``BLOCK_RADIUS`` bits turned, marked with its number."""
    every = np.arange(1 << BLOCK_BITS, dtype=np.int32)
    masks = every[np.bitwise_count(every) <= BLOCK_RADIUS]
    own = [(value >> n * BLOCK_BITS) & ((1 << BLOCK_BITS) - 1) for n in range(BLOCKS)]
    return np.concatenate([(masks ^ block) + (n << BLOCK_BITS) for n, block in enumerate(own)])


def slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """Places in the filter of shingles that belong to items of ``size`` words (0: of any)."""
    salt = np.uint64(size * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return mixed(hashes + salt) & np.uint64((1 << FILTER_BITS) - 1)


def item_rows(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """Per item with a word: its words, shingle hashes, fingerprint, block keys and filter places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for item, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = word_hashes(own, known)
                if not len(words):
                    continue
                made = shingles(words, width_of(len(words)))
                places = np.concatenate([slots(made, 0), slots(made, len(words))])
                own_print = fingerprint(made)
                blocks = near_blocks(own_print)
                values = (item, len(words), made.view(np.int64), own_print, blocks, places.view(np.int64))
                for column, value in zip(rows, values):
                    column.append(value)
            longs = pa.list_(pa.int64())
            kinds = [batch.column(0).type, pa.int64(), longs, pa.int64(), pa.list_(pa.int32()), longs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, kinds)], ["item_id", "size", "item", "item_fp", "blocks", "places"]
            )

    picked = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    kind = picked.schema["item_id"].dataType.simpleString()
    made = picked.mapInArrow(
        run, f"item_id {kind}, size bigint, item array<bigint>, item_fp bigint, blocks array<int>, places array<bigint>"
    )
    # Ids may be null or used twice, so items are told apart by id and content.
    return stage(made.withColumn("item_key", F.xxhash64("item_id", "item")), "items")


def shingle_filter(items: DataFrame) -> np.ndarray:
    """A bit per place, set where a benchmark shingle falls; 2 MB for any benchmark."""
    words = (
        items.select(F.explode("places").alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits"))
    )
    found = words.toPandas()
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return table.view(np.uint64)


def is_set(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (table[places >> np.uint64(6)] >> (places & np.uint64(63)) & np.uint64(1)).astype(bool)


def needed(shingle_count: int) -> int:
    """Shingles that a window must share with an item of its size to be similar enough.

    With k shingles each and i shared the similarity is i / (2k - i).
    """
    return int(np.ceil(2 * SIMILARITY / (1 + SIMILARITY) * shingle_count - 1e-9))


def needed_whole(own: int, shingle_count: int) -> int:
    """Shingles that a text of ``own`` shingles must share with a longer item to be similar enough."""
    return int(np.ceil(SIMILARITY / (1 + SIMILARITY) * (own + shingle_count) - 1e-9))


def windows_of(
    text: str | None, known: WordHashes, table: np.ndarray, sizes: list[int], short_texts: bool = False
) -> list[tuple]:
    """The windows of a text that can be similar to an item: start, size, shingles, fingerprint.

    With ``short_texts`` a text with fewer words than an item is its window as a whole.
    The filter only leaves out windows that provably share too few shingles with all
    items of their size.
    """
    words = word_hashes(text, known)
    by_width = {w: shingles(words, w) for w in {width_of(s) for s in sizes}}
    any_of = {w: np.flatnonzero(is_set(table, slots(h, 0))) for w, h in by_width.items()}
    out = []
    for size in sizes:
        width = width_of(size)
        hashes, at = by_width[width], any_of[width]
        count = size - width + 1
        if len(words) < size:
            least = needed_whole(len(hashes), count)
            if short_texts and least <= len(hashes) and len(at) >= least and is_set(table, slots(hashes[at], size)).sum() >= least:
                out.append((0, size, hashes.view(np.int64), fingerprint(hashes)))
            continue
        if len(at) < needed(count):
            continue
        hit = np.zeros(len(hashes) + 1, np.int64)
        hit[at + 1] = is_set(table, slots(hashes[at], size))
        total = np.cumsum(hit)
        for start in np.flatnonzero(total[count:] - total[:-count] >= needed(count)).tolist():
            own = hashes[start : start + count]
            out.append((start, size, own.view(np.int64), fingerprint(own)))
    return out


def window_rows(docs: DataFrame, items: DataFrame, short_texts: bool = False) -> DataFrame:
    """The windows of all texts (columns doc_id, _k1, _k2, _text) that can match an item."""
    context = docs.sparkSession.sparkContext
    # Distinct lengths of the items: no more than words in the longest one.
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    table = context.broadcast(shingle_filter(items))
    names = ["doc_id", "_k1", "_k2", "start", "size", "window", "window_fp"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids, rows = [], []
            first, second = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for i in range(len(batch)):
                text = batch.column(3)[i].as_py()
                for window in windows_of(text, known, table.value, sizes, short_texts):
                    ids.append(i)
                    rows.append((first[i], second[i], *window))
                if len(rows) * 64 > CHUNK_CHARS or i == len(batch) - 1:
                    columns = list(zip(*rows)) or [()] * len(kinds)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(ids, pa.int64())), *map(pa.array, columns, kinds)], names
                    )
                    ids, rows = [], []

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "_k1", "_k2", "_text").mapInArrow(
        run,
        f"doc_id {kind}, _k1 bigint, _k2 bigint, start bigint, size bigint, window array<bigint>, window_fp bigint",
    )


def block_keys(value: Column) -> Column:
    """The blocks of a fingerprint, marked with their numbers."""
    blocks = []
    for n in range(BLOCKS):
        block = F.shiftrightunsigned(value, n * BLOCK_BITS).bitwiseAND((1 << BLOCK_BITS) - 1)
        blocks.append(block.cast("int") + n * (1 << BLOCK_BITS))
    return F.array(*blocks)


def weighted_similarity(window: list[int], item: list[int]) -> float:
    a, b = Counter(window), Counter(item)
    shared = sum((a & b).values())
    return shared / (len(window) + len(item) - shared)


def verified(pairs: DataFrame) -> DataFrame:
    """The exact similarity of candidate pairs by their shingles, as column ``similarity``."""
    names = [c for c in pairs.columns if c not in ("window", "item")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = map(weighted_similarity, batch.column("window").to_pylist(), batch.column("item").to_pylist())
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(found), pa.float64())], [*names, "similarity"])

    kinds = dict(pairs.dtypes)
    return pairs.mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in names], "similarity double"]))


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    short_texts: bool = False,
) -> DataFrame:
    """Documents that hold a benchmark item: one row per text and item.

    Columns: doc_id, a row key, item_id, ``similarity`` of the best window, ``start``
    (the first word of that window, the earliest at ties) and ``n_windows``, the number
    of windows with weighted similarity of five-word shingles of 0.8 or more. A
    window has as many words as the item; with ``short_texts`` a text of fewer words
    is one window as a whole, so items cut short are found, too. Words are runs of
    letters and digits in lower case, so case and punctuation do not matter. An item of fewer than five
    words is one shingle; items without a word, and null or empty texts on either
    side, match nothing. Items that are equal are all reported, as are documents
    that are equal; rows equal in id and text count once. Empty tables give no rows.
    Other columns are not read.
    """
    items = item_rows(benchmark, item_id, item_text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    rows = rows.select("doc_id", *row_key(F.col("doc_id"), F.col("_text")), "_text")
    windows = stage(window_rows(rows, items, short_texts).distinct(), "windows")
    index = items.select("item_key", "size", "item_fp", F.explode("blocks").alias("block"))
    asked = windows.drop("window").withColumn("block", F.explode(block_keys(F.col("window_fp"))))
    # The planner does not see how many rows an item becomes, so the join is said to be by merging.
    index = index.hint("merge")
    close = F.bit_count(F.col("item_fp").bitwiseXOR(F.col("window_fp"))) <= RADIUS
    candidates = (
        asked.join(index, ["size", "block"])
        .filter(close)
        .select("doc_id", "_k1", "_k2", "start", "size", "item_key")
        .distinct()
    )
    pairs = candidates.join(windows.select("_k1", "_k2", "start", "size", "window"), ["_k1", "_k2", "start", "size"])
    pairs = pairs.join(items.select("item_key", "item_id", "item").dropDuplicates(["item_key"]), "item_key")
    found = verified(pairs.select("doc_id", "_k1", "_k2", "item_id", "start", "window", "item")).filter(
        F.col("similarity") >= SIMILARITY
    )
    return found.groupBy("doc_id", "_k1", "_k2", "item_id").agg(
        F.max("similarity").alias("similarity"),
        F.min_by("start", F.struct(-F.col("similarity"), F.col("start"))).alias("start"),
        F.countDistinct("start").alias("n_windows"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", short_texts: bool = False
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns stay, whatever their names."""
    matches = benchmark_matches(docs, benchmark, text, doc_id, short_texts=short_texts)
    found = stage(matches.select("_k1", "_k2").distinct(), "contaminated")
    rows = docs.select(whole_row(docs).alias("_row"), *row_key(F.col(doc_id), F.col(text)))
    return unpack(rows.join(found, ["_k1", "_k2"], "left_anti"), docs.columns)
