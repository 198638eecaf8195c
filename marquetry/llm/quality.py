"""Quality rules on repetition inside a text, found with a suffix array."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, map_texts

#: Fixed values of the base rules.
SYMBOLS, LEAST_WORDS, WINDOW, REPEAT_PERCENT = "#*$%&|<>", 10, 5, 20

COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, longest_repeat bigint, covered_share double, kept boolean"
)


class WordIds(dict):
    """Numbers words in the order in which they are asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def suffix_ranks(codes: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, … codes, the last being total.

    ``ends[i]`` is where the text of position i ends; codes differ between texts.
    Only suffixes that still share a rank are sorted again in a round.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    new = np.ones(n, bool)
    new[1:] = codes[order[1:]] != codes[order[:-1]]
    at = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, at, 0))
    levels, step = [rank], 1
    alone = new & np.append(new[1:], True)
    open_ = order[~alone]
    while len(open_):
        after = open_ + step
        inside = after < ends[open_]
        following = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[open_] * (n + 2) + following
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        old = key // (n + 2)
        at = np.arange(len(open_))
        first_old = np.ones(len(open_), bool)
        first_old[1:] = old[1:] != old[:-1]
        first_new = np.ones(len(open_), bool)
        first_new[1:] = key[1:] != key[:-1]
        begin = np.maximum.accumulate(np.where(first_old, at, 0))
        split = np.maximum.accumulate(np.where(first_new, at, 0))
        rank = rank.copy()
        rank[open_] = old + split - begin
        levels.append(rank)
        alone = first_new & np.append(first_new[1:], True)
        open_ = open_[~alone]
        step *= 2
    return levels


def longest_repeats(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position the length of the longest prefix that occurs elsewhere in its text.

    This is the depth of the innermost longest-common-prefix interval that holds
    the suffix: the larger of its common prefixes with its two neighbours.
    """
    n = len(codes)
    levels = suffix_ranks(codes, ends)
    order = np.empty(n, np.int64)
    order[levels[-1]] = np.arange(n)
    pairs = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    left, right = order[pairs], order[pairs + 1]
    common = np.zeros(len(pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        fits = (a < n) & (b < n)
        same = fits & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        common += same.astype(np.int64) << k
    depth = np.zeros(n, np.int64)
    np.maximum.at(depth, left, common)
    np.maximum.at(depth, right, common)
    return depth


def covered(depth: np.ndarray, at_least: int) -> np.ndarray:
    """Positions inside the union of all repeats of ``at_least`` words or more.

    Every maximal repeat starts at a position whose depth is its length, so the
    union of the maximal repeats is the union of these spans.
    """
    at = np.arange(len(depth))
    reach = np.maximum.accumulate(np.where(depth >= at_least, at + depth, 0))
    return reach > at


def measure(
    texts: list[str], min_repeat: int, max_covered: float, max_repeat: int
) -> list[np.ndarray]:
    space, symbols = SPACE.encode(), SYMBOLS.encode()
    rows, n = len(texts), np.zeros(len(texts), np.int64)
    chars, marks, lines = n.copy(), n.copy(), n.copy()
    ids, words = WordIds(), []
    for i, text in enumerate(texts):
        raw = text.encode()
        own = raw.split()
        n[i] = len(own)
        words += map(ids.__getitem__, own)
        chars[i] = len(text) - (len(raw) - len(raw.translate(None, space)))
        marks[i] = len(raw) - len(raw.translate(None, symbols))
        full = [line for line in raw.split(b"\n") if line.strip()]
        lines[i] = len(full) - len(set(full))
    row = np.repeat(np.arange(rows), n)
    repeated, inside, longest = np.zeros(rows), np.zeros(rows), np.zeros(rows, np.int64)
    if words:
        codes = row * len(ids) + np.array(words, np.int64)
        depth = longest_repeats(codes, np.repeat(np.cumsum(n), n))
        repeated = np.bincount(row, covered(depth, WINDOW), rows)
        inside = np.bincount(row, covered(depth, min_repeat), rows)
        np.maximum.at(longest, row, depth)
    repeated = repeated.astype(np.int64)
    failed = (n < LEAST_WORDS) | (100 * repeated > REPEAT_PERCENT * n)
    share = inside / np.maximum(n, 1)
    kept = ~failed & (share <= max_covered) & (longest <= max_repeat)
    return [n, chars, marks, lines, repeated, failed, longest, share, kept]


def repetition_rules(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    min_repeat: int = 8,
    max_covered: float = 0.15,
    max_repeat: int = 50,
) -> DataFrame:
    """The counts of the base rules, the repeats of each whole text, and a verdict.

    A text is dropped by the base rules, if repeats of ``min_repeat`` words or more
    cover over ``max_covered`` of its words, or if its longest repeat has over
    ``max_repeat`` words. One row per input row: a null text counts as empty and an
    empty text has no words, so both fail the base; a text of any length is
    measured whole; equal rows give equal rows; an empty table gives none. Columns
    other than ``keep`` and ``text`` are not read, whatever they are called.
    """

    def compute(texts: list[str]) -> list[np.ndarray]:
        return measure(texts, min_repeat, max_covered, max_repeat)

    picked = docs.select(*[F.col(c) for c in keep], F.col(text).alias("_text"))
    return map_texts(picked, list(keep), "_text", compute, COLUMNS)
