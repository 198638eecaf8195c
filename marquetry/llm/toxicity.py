"""Toxicity: a bidirectional gated recurrent network with attention pooling, over words and their characters."""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .search import FOLD

#: Words of a window, and from the start of one window to that of the next.
WINDOW, STRIDE = 32, 16
#: Width of word vectors, of character vectors, of the state and of the attention.
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 8, 8, 8, 8
#: Rows of the hashed tables, and the training texts that must hold what a row stands for.
WORD_ROWS, GRAM_ROWS, LEAST_TEXTS = 1 << 15, 1 << 17, 3
#: Lengths of character runs; the marks around a word count as characters.
RUNS = (3, 4, 5)

#: The bound of the training sample: labelled rows of each class, and words of one.
TRAIN_ROWS, TRAIN_WORDS = 1_200, 1_500
#: Passes, texts of a batch, steps of the weights and of the tables, and shrinkage of the tables.
PASSES, BATCH, STEP, TABLE_STEP, SHRINK = 4, 16, 0.02, 0.2, 1e-5
#: Folds of the ids; this one's labels are never learned from.
FOLDS, HELD_FOLD = 3, 1
#: Windows that are run at a time, and distinct words that a task remembers.
WINDOWS, REMEMBERED = 1_024, 300_000

GATES = 3 * HIDDEN


def words_of(text: str) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, in lower case."""
    return text.lower().encode().translate(FOLD).split()


def char_runs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all character runs of the words, and the word of each, in order of the words."""
    marked = b"\x00" + b"\x00".join(words) + b"\x00"
    codes = np.frombuffer(marked.decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    is_mark = codes == 0
    word = np.cumsum(is_mark) - 1
    marks = np.flatnonzero(is_mark)
    ends = np.append(marks[1:], len(codes))[word]
    place = np.arange(len(codes))
    rows, owner = [], []
    for size in RUNS:
        rolled = np.full(max(len(codes) - size + 1, 0), size, np.uint64)
        for k in range(size):
            rolled = rolled * np.uint64(0x100000001B3) + codes[k : k + len(rolled)] + np.uint64(1)
        mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        good = (place + size - 1 <= ends)[: len(rolled)]
        rows.append((mixed >> np.uint64(64 - GRAM_ROWS.bit_length() + 1))[good].astype(np.int64))
        owner.append(word[: len(rolled)][good])
    found, of = np.concatenate(rows), np.concatenate(owner)
    order = np.argsort(of, kind="stable")
    return found[order], of[order]


def word_rows(words: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(w) & (WORD_ROWS - 1) for w in words], np.int64)


def windows_of(ids: np.ndarray) -> np.ndarray:
    """All windows of a text, one per row, 0 behind its end; a text without words is one empty window."""
    n = len(ids)
    count = max(1, -(-(n - WINDOW) // STRIDE) + 1)
    padded = np.zeros((count - 1) * STRIDE + WINDOW, np.int64)
    padded[:n] = ids
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Weights by name. ``word`` and ``gram`` are hashed tables; an input is a word's row of
    the first and the sum of its character runs' rows of the second, over the root of
    their number. It is projected to the gates of both directions."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = weights

    @classmethod
    def start(cls, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)

        def some(*shape: int) -> np.ndarray:
            return (rng.normal(size=shape) / np.sqrt(shape[-2] if len(shape) > 1 else shape[-1])).astype(np.float32)

        zero = np.zeros
        return cls(
            {
                "word": rng.normal(0, 0.3, (WORD_ROWS, WORD_DIM)).astype(np.float32),
                "gram": rng.normal(0, 0.3, (GRAM_ROWS, CHAR_DIM)).astype(np.float32),
                "into": some(WORD_DIM + CHAR_DIM, 2 * GATES),
                "gate_bias": zero(2 * GATES, np.float32),
                "state": some(2, HIDDEN, GATES),
                "attend": some(2 * HIDDEN, ATTEND),
                "attend_out": some(ATTEND),
                "out": some(2 * HIDDEN),
                "bias": np.full(1, -2, np.float32),
            }
        )

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.w)
        return out.getvalue()

    @classmethod
    def unpack(cls, packed: bytes) -> Network:
        with np.load(io.BytesIO(packed)) as read:
            return cls({k: read[k] for k in read.files})

    def inputs(self, rows: np.ndarray, runs: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vectors of words, and the root of the number of runs of each."""
        count = np.bincount(owner, minlength=len(rows))
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        sums = np.add.reduceat(self.w["gram"][runs], first) if len(runs) else np.zeros((0, CHAR_DIM), np.float32)
        scale = np.sqrt(np.maximum(count, 1)).astype(np.float32)[:, None]
        return np.concatenate([self.w["word"][rows], sums / scale], 1), scale

    def gates(self, words: list[bytes]) -> np.ndarray:
        """What the words add to the gates."""
        if not words:
            return np.zeros((0, 2 * GATES), np.float32)
        vectors, _ = self.inputs(word_rows(words), *char_runs(words))
        return vectors @ self.w["into"] + self.w["gate_bias"]

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Logits of windows. ``x``: steps, directions, gates, windows, the second direction
        from the end; ``mask`` likewise, 1 for words."""
        steps, _, _, n = x.shape
        state = np.ascontiguousarray(self.w["state"].transpose(0, 2, 1))
        h = np.zeros((2, HIDDEN, n), np.float32)
        both = np.empty((2 * HIDDEN, steps, n), np.float32)
        kept: list[tuple] = []
        for t in range(steps):
            inner = state @ h
            zr = sigmoid(x[t, :, : 2 * HIDDEN] + inner[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            q = inner[:, 2 * HIDDEN :]
            new = np.tanh(x[t, :, 2 * HIDDEN :] + r * q)
            if keep:
                kept.append((h, z, r, q, new))
            h = h + mask[t] * (1 - z) * (new - h)
            both[:HIDDEN, t], both[HIDDEN:, steps - 1 - t] = h
        tanh = np.tanh(np.tensordot(self.w["attend"].T, both, 1))
        raw = np.tensordot(self.w["attend_out"], tanh, 1) - 1e4 * (1 - mask[:, 0, 0])
        share = np.exp(raw - raw.max(0))
        share /= share.sum(0)
        pooled = np.einsum("tn,htn->hn", share, both)
        logits = self.w["out"] @ pooled + self.w["bias"][0]
        return logits, {"kept": kept, "both": both, "tanh": tanh, "share": share, "pooled": pooled} if keep else {}

    def backward(self, d: np.ndarray, mask: np.ndarray, seen: dict) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights behind the inputs, and that of the inputs, for that of the logits."""
        both, tanh, share = seen["both"], seen["tanh"], seen["share"]
        grads = {"out": seen["pooled"] @ d, "bias": d.sum(keepdims=True)}
        d_pooled = self.w["out"][:, None] * d
        d_share = np.einsum("htn,hn->tn", both, d_pooled)
        d_raw = share * (d_share - (share * d_share).sum(0))
        grads["attend_out"] = np.tensordot(tanh, d_raw, 2)
        d_tanh = self.w["attend_out"][:, None, None] * d_raw * (1 - tanh * tanh)
        grads["attend"] = np.tensordot(both, d_tanh, ((1, 2), (1, 2)))
        d_both = share * d_pooled[:, None] + np.tensordot(self.w["attend"], d_tanh, 1)
        steps = both.shape[1]
        state = self.w["state"]
        d_state, d_h = np.zeros_like(state), np.zeros((2, HIDDEN, len(d)), np.float32)
        d_x = np.empty((steps, 2, GATES, len(d)), np.float32)
        for t in reversed(range(steps)):
            h, z, r, q, new = seen["kept"][t]
            d_h = d_h + np.stack([d_both[:HIDDEN, t], d_both[HIDDEN:, steps - 1 - t]])
            d_new = d_h * mask[t] * (1 - z) * (1 - new * new)
            d_z = -d_h * mask[t] * (new - h) * z * (1 - z)
            d_r = d_new * q * r * (1 - r)
            d_x[t] = np.concatenate([d_z, d_r, d_new], 1)
            d_inner = np.concatenate([d_z, d_r, d_new * r], 1)
            d_state += h @ d_inner.transpose(0, 2, 1)
            d_h = d_h * (1 - mask[t] * (1 - z)) + state @ d_inner
        grads["state"] = d_state
        return grads, d_x


def laid_out(table: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and mask for :meth:`Network.forward`; ``table`` has a row of gates per id, ids begin at 1."""
    ids = windows.T
    x = np.empty((len(ids), 2, GATES, len(windows)), np.float32)
    for t, own in enumerate(ids):
        found = table[own].T
        x[t, 0], x[len(ids) - 1 - t, 1] = found[:GATES], found[GATES:]
    mask = (ids > 0).astype(np.float32)
    return x, np.stack([mask, mask[::-1]], 1)[:, :, None]


def add_at(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a table and the sums of their gradients."""
    order = np.argsort(at, kind="stable")
    rows, first = np.unique(at[order], return_index=True)
    return rows, np.add.reduceat(values[order], first)


class Trainer:
    """Adam for the weights; rows of the tables step by the root of the summed squares of their gradients."""

    def __init__(self, net: Network, words: list[bytes], texts: list[np.ndarray]) -> None:
        self.net, self.rows = net, word_rows(words)
        runs, owner = char_runs(words)
        self.first = np.searchsorted(owner, np.arange(len(words) + 1))
        self.runs = runs
        self.squares = {k: np.full(len(net.w[k]), 1e-9, np.float32) for k in ("word", "gram")}
        self.moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.w.items() if k not in self.squares}
        self.steps = 0
        word_texts, gram_texts = np.zeros(WORD_ROWS, np.int32), np.zeros(GRAM_ROWS, np.int32)
        for ids in texts:
            own = np.unique(ids) - 1
            word_texts[np.unique(self.rows[own])] += 1
            gram_texts[np.unique(self.runs_of(own)[0])] += 1
        net.w["word"][word_texts < LEAST_TEXTS] = 0
        net.w["gram"][gram_texts < LEAST_TEXTS] = 0
        self.known = {"word": word_texts >= LEAST_TEXTS, "gram": gram_texts >= LEAST_TEXTS}

    def runs_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, lengths = self.first[words], np.diff(self.first)[words]
        owner = np.repeat(np.arange(len(words)), lengths)
        within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return self.runs[np.repeat(starts, lengths) + within], owner

    def step(self, texts: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray) -> float:
        """One step on some texts: the soft maximum of a text's windows is held against its label."""
        w = self.net.w
        parts = [windows_of(ids) for ids in texts]
        windows = np.concatenate(parts)
        of = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        own, local = np.unique(windows, return_inverse=True)
        local = local.reshape(windows.shape)
        if own[0] != 0:
            own, local = np.concatenate([[0], own]), local + 1
        words = own[1:] - 1
        runs, owner = self.runs_of(words)
        vectors, scale = self.net.inputs(self.rows[words], runs, owner)
        table = np.concatenate([np.zeros((1, 2 * GATES), np.float32), vectors @ w["into"] + w["gate_bias"]])
        x, mask = laid_out(table, local)
        logits, seen = self.net.forward(x, mask, keep=True)
        most = np.full(len(texts), -np.inf, np.float32)
        np.maximum.at(most, of, logits)
        part = np.exp(logits - most[of])
        total = np.bincount(of, part, len(texts)).astype(np.float32)
        soft = most + np.log(total)
        loss = np.logaddexp(0, np.where(toxic, -soft, soft))
        d_text = (sigmoid(soft) - toxic) * weight / weight.sum()
        d = (d_text[of] * part / total[of]).astype(np.float32)
        grads, d_x = self.net.backward(d, mask, seen)
        d_both = np.concatenate([d_x[:, 0], d_x[::-1, 1]], 1).transpose(0, 2, 1).reshape(-1, 2 * GATES)
        touched, sums = add_at(local.T.ravel(), d_both)
        d_table = np.zeros_like(table)
        d_table[touched] = sums
        d_table = d_table[1:]
        grads["into"], grads["gate_bias"] = vectors.T @ d_table, d_table.sum(0)
        d_vectors = d_table @ w["into"].T
        for name, at, value in (
            ("word", self.rows[words], d_vectors[:, :WORD_DIM]),
            ("gram", runs, (d_vectors[:, WORD_DIM:] / scale)[owner]),
        ):
            rows, sums = add_at(at, value)
            good = self.known[name][rows]
            rows, sums = rows[good], sums[good] + SHRINK * w[name][rows[good]]
            self.squares[name][rows] += (sums * sums).mean(1)
            w[name][rows] -= TABLE_STEP * sums / np.sqrt(self.squares[name][rows])[:, None]
        self.steps += 1
        for name, grad in grads.items():
            mean, square = self.moments[name]
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad * grad - square)
            size = np.sqrt(square / (1 - 0.999**self.steps)) + 1e-8
            w[name] -= STEP * mean / (1 - 0.9**self.steps) / size
        return float((loss * weight).sum() / weight.sum())


def fit(texts: list[str], toxic: list[int]) -> Network:
    """The network of some labelled texts; the classes weigh the same."""
    split = [words_of(t) for t in texts]
    words = sorted({w for own in split for w in own})
    number = {w: i + 1 for i, w in enumerate(words)}
    ids = [np.array([number[w] for w in own], np.int64) for own in split]
    labels = np.array(toxic, np.float32)
    net = Network.start()
    trainer = Trainer(net, words, ids)
    share = np.where(labels > 0, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1)).astype(np.float32)
    rng = np.random.default_rng(5)
    for _ in range(PASSES):
        order = rng.permutation(len(ids))
        for start in range(0, len(ids), BATCH):
            own = order[start : start + BATCH]
            trainer.step([ids[i] for i in own], labels[own], share[own])
    return net


class Scorer:
    """Scores texts; it remembers the gates of words."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.table = np.zeros((1, 2 * GATES), np.float32)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        split = [words_of(t) for t in texts]
        if len(self.number) > REMEMBERED:
            self.forget()
        number = self.number
        new = list(dict.fromkeys(w for own in split for w in own if w not in number))
        number.update(zip(new, range(len(number) + 1, len(number) + 1 + len(new))))
        self.table = np.concatenate([self.table, *[self.net.gates(new[i : i + 50_000]) for i in range(0, len(new), 50_000)]])
        return [np.fromiter(map(number.__getitem__, own), np.int64, len(own)) for own in split]

    def scores(self, texts: list[str]) -> np.ndarray:
        """The probability of the label by the text's most toxic window."""
        logits, sizes = [], []
        for ids in self.ids(texts):
            logits.append(windows_of(ids))
            sizes.append(len(logits[-1]))
        windows = np.concatenate(logits)
        found = np.concatenate(
            [self.net.forward(*laid_out(self.table, windows[i : i + WINDOWS]))[0] for i in range(0, len(windows), WINDOWS)]
        )
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return sigmoid(np.maximum.reduceat(found, first).astype(np.float64))


def fold(doc_id: F.Column) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``_text`` and ``toxic`` of at most ``TRAIN_ROWS`` rows of each class, those with the least hashes.

    The ids are chosen from the labels, so only they (a bounded number) are sent to
    the scan of the documents. An id with several labels has the highest.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_FOLD))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    classes = [F.col("toxic") > 0, F.col("toxic") <= 0]
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(3))
    ids = [known.filter(c).orderBy(order, "doc_id").limit(2 * TRAIN_ROWS) for c in classes]
    chosen = F.broadcast(ids[0].unionByName(ids[1]))
    rows = docs.join(chosen, "doc_id").filter(F.size(F.split("_text", r"\s+")) <= TRAIN_WORDS)
    rows = rows.withColumn("_h", F.xxhash64(F.col("doc_id").cast("string"), "_text"))
    parts = [rows.filter(c).orderBy("_h", "_text").limit(TRAIN_ROWS) for c in classes]
    return parts[0].unionByName(parts[1])


def train(docs: DataFrame, labels: DataFrame) -> bytes | float:
    """The packed network, or without rows of both classes the toxic share, with one of each added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted({(h, t or "", y > 0) for b in batches for h, t, y in zip(*(c.to_pylist() for c in b.columns))})
        toxic = [int(y) for _, _, y in rows]
        packed = fit([t for _, t, _ in rows], toxic).pack() if 0 < sum(toxic) < len(toxic) else None
        share = (sum(toxic) + 1) / (len(toxic) + 2)
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary()), pa.array([share])], names=["net", "share"])

    sample = training_rows(docs, labels).select("_h", "_text", "toxic").repartition(1)
    found = sample.mapInArrow(run, "net binary, share double").collect()
    return (found[0]["net"] or found[0]["share"]) if found else 0.5


def score_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from a score of 0.7) of each whole text.

    Labels (``doc_id``, ``toxic``) teach from all folds but one. One task trains on
    a bounded sample (``TRAIN_ROWS`` rows of each class, of up to ``TRAIN_WORDS``
    words); the network is then sent to all tasks, which run it over all
    overlapping windows of every text. The most toxic window counts. A score
    depends on the text and the network alone.

    One row per input row: a null or empty text is one window without words, and
    repeated rows repeat. A null id has the empty string's fold. A very long text
    has many windows, run some thousand at a time. Labels for no document, null
    labels and null ids teach nothing. Without rows of both classes every score is
    the toxic share. An empty table gives no rows; no other column is read.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    model = train(picked, labels.select("doc_id", "toxic"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list[str]) -> list[np.ndarray]:
        if isinstance(shared.value, float):
            return [np.full(len(texts), shared.value)]
        return [scorer(shared).scores(texts)]

    held = picked.withColumn("held_out", fold(F.col("doc_id")) == HELD_FOLD)
    scored = map_texts(held, ["doc_id", "held_out"], "_text", compute, "score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


_scorers: dict[int, Scorer] = {}


def scorer(shared: Broadcast) -> Scorer:
    """The scorer of a worker process; it keeps one network."""
    key = zlib.crc32(shared.value)
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(Network.unpack(shared.value))
    return _scorers[key]
