"""Small tables with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

from collections import Counter

import numpy as np
import xxhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LOREM = (
    "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau "
    "upsilon phi chi psi omega one two three four five six seven eight nine ten eleven twelve thirteen "
    "fourteen fifteen sixteen seventeen eighteen nineteen twenty"
)


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, extra columns."""
    rows = [
        (1, LOREM, "en", "a", 10),
        (2, LOREM, "en", "b", 10),  # an exact copy
        (3, LOREM.replace("omicron", "big"), "en", "a", 10),
        (4, None, "en", "a", None),
        (5, "", None, None, 0),
        (6, " \n\t ", "xx", "", 4),
        (None, "some words of a row without id", "en", "c", 1),
        (None, None, None, None, None),
        (7, "word " * 40_000 + "end", "en", "a", 200_003),
        (8, "repeated row with text", "de", "b", 3),
        (8, "repeated row with text", "de", "b", 3),
        (8, "the same id with other text", "de", "b", 3),
        (9, "é" * 5_000 + "\n" + "ß ü\n" * 300, "fr", "c", 5),
    ]
    extra = "_k1 string, _row string, _text string, fp string, component string, copy string, kept string, language string, `a b` string"
    names = SCHEMA + ", " + extra
    return spark.createDataFrame([(*r, *["x"] * 9) for r in rows], names)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def simhash(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_components(ids: list, prints: list[int], radius: int = 4) -> list:
    """The smallest id reachable over links of at most ``radius`` bits."""
    values = np.array(prints, np.uint64)
    group = list(range(len(ids)))

    def find(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= radius).tolist():
            group[find(i)] = find(j)
    roots = [find(i) for i in range(len(ids))]
    least: dict[int, object] = {}
    for root, own in zip(roots, ids):
        if own is not None:
            least[root] = own if least.get(root) is None else min(least[root], own)
    return [least.get(r) for r in roots]


def weighted(a: list, b: list) -> float:
    x, y = Counter(a), Counter(b)
    return sum((x & y).values()) / sum((x | y).values())
