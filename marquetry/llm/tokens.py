"""Token counts by greedy longest match, without building the pieces."""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterable
from functools import lru_cache
from pathlib import Path

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: Distinct words whose counts a task remembers.
REMEMBERED = 200_000


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a vocabulary file with a base64 piece and a rank per line."""
    lines = Path(path).read_bytes().splitlines()
    return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class MatchAutomaton:
    """A trie of pieces with failure links, for greedy longest match in one pass.

    When a node has no edge for the next byte, the pieces that greedy matching
    would cut off there are fixed, and so is the node where what is left of the
    matched string leads: ``popped`` has the number of those pieces, ``fail`` the
    node (-1: nothing can be cut off). ``closing`` is the number of pieces cut off
    if the word ends at the node, -1 if it cannot be cut up.
    """

    def __init__(self, pieces: Iterable[bytes]) -> None:
        edges: dict[int, int] = {}
        final, depth_of = [False], [[]]
        for piece in pieces:
            node = 0
            for depth, byte in enumerate(piece):
                after = edges.get(node << 8 | byte)
                if after is None:
                    after = edges[node << 8 | byte] = len(final)
                    final.append(False)
                    if len(depth_of) <= depth:
                        depth_of.append([])
                    depth_of[depth].append((node, byte, after))
                node = after
            if node:
                final[node] = True
        popped, fail = [0] * len(final), [-1] * len(final)
        for level in depth_of:
            for node, byte, after in level:
                if final[after]:
                    popped[after], fail[after] = 1, 0
                    continue
                count, back = popped[node], fail[node]
                while back >= 0 and (back << 8 | byte) not in edges:
                    count += popped[back]
                    back = fail[back]
                if back >= 0:
                    popped[after], fail[after] = count, edges[back << 8 | byte]
        closing = [0] * len(final)
        for level in depth_of:
            for _, _, node in level:
                back = fail[node]
                whole = back >= 0 and closing[back] >= 0
                closing[node] = popped[node] + closing[back] if whole else -1
        self.edges, self.popped, self.fail, self.closing = edges, popped, fail, closing

    def count(self, word: bytes) -> int:
        """The number of pieces of ``word``; 1 if it cannot be cut up (unknown)."""
        edges, popped, fail = self.edges, self.popped, self.fail
        node = total = 0
        for byte in word:
            after = edges.get(node << 8 | byte)
            while after is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                after = edges.get(node << 8 | byte)
            node = after
        return total + self.closing[node] if self.closing[node] >= 0 else 1


def count_tokens(
    docs: DataFrame,
    pieces: list[bytes],
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep``, n_tokens, n_words and n_chars (code points) of each whole text.

    Words are split at ASCII white space and matched with a space before them, as
    pieces that begin words have it in such vocabularies; a word that cannot be
    cut up is one unknown token. The vocabulary is broadcast: its size is that of
    a file, whatever the corpus. One row per input row: null and empty texts count
    0, repeated rows repeat, an empty table gives no rows, other columns are not
    read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sorted(set(pieces)))
    name = uuid.uuid4().hex

    def compute(texts: list[str]) -> list[np.ndarray]:
        count = word_counter(name, shared)
        split = [t.encode().split() for t in texts]
        return [
            np.array([sum(map(count, words)) for words in split], np.int64),
            np.array([len(words) for words in split], np.int64),
            np.array([len(t) for t in texts], np.int64),
        ]

    picked = docs.select(*[F.col(c) for c in keep], F.col(text).alias("_text"))
    return map_texts(picked, list(keep), "_text", compute, "n_tokens bigint, n_words bigint, n_chars bigint")


_counters: dict[str, Callable[[bytes], int]] = {}


def word_counter(name: str, shared: Broadcast) -> Callable[[bytes], int]:
    """The counting function of a worker process; it keeps one vocabulary."""
    if name not in _counters:
        _counters.clear()
        automaton = MatchAutomaton(shared.value)
        _counters[name] = lru_cache(REMEMBERED)(lambda word: automaton.count(b" " + word))
    return _counters[name]
