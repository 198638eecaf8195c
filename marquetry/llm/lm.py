"""Language-model scores: a log-bilinear model, trained with noise-contrastive estimation."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.sources.scratch import stage

from .common import CHUNK_CHARS, map_texts, row_key

#: The token that ends every text; no word can hold a line break.
END = "\n"
#: Fixed values of the base score, and of the rows that are held out.
ADDED, FOLDS = 0.1, 10
#: A token that makes up this share of all tokens goes to every task, so there are a
#: million of them at most. Counts of all others are joined.
HEAD_SHARE = 1e-6
#: A word with this share of all tokens, or this many times the root of their number, has vectors
#: of its own in the model, if it is in the head; all others are one item with unigram odds
#: inside. The shares of words settle as a corpus grows, so from 10^8 tokens on the root
#: lets more words in, until the bound of the head stands at 10^10.
MODEL_SHARE, MODEL_ROOT = 1e-5, 0.1
#: Size of word vectors, noise classes per batch, noise words per token, tokens per batch.
WIDTH, NOISE, INNER, BATCH = 16, 16, 3, 4096
#: Step of the training, and the sum of squared gradients with which each parameter starts.
STEP, CALM = 0.1, 64.0
#: Texts, about, on which the parameters are warmed up, and passes over them.
WARM_TEXTS, WARM_PASSES = 2_000, 4
#: Models that one task averages.
FAN_IN = 64
#: Training tokens, about, on which one model is trained before the average.
SHARD_TOKENS = 4_000_000
#: Characters whose words are counted before the counts go to Spark.
COUNT_CHARS = 4 * CHUNK_CHARS


@dataclass
class Head:
    """The frequent tokens, the most frequent first, and what the scores need of the rest.

    The model's items are its words and, as one more, all other tokens, by falling share.
    They are cut into classes of about equal shares, the root of their number of them, so
    a class is a frequent item alone, or a run of ever more rare ones.
    """

    index: dict[bytes, int]
    logs: np.ndarray  # log10(count + ADDED)
    item: np.ndarray  # of each token of the head that has one of its own
    share: np.ndarray  # of each item in the training tokens
    other: int  # the item of all other tokens
    starts: np.ndarray  # the first item of each class, and behind them the number of items
    outside: int  # training tokens of the item ``other``


@dataclass
class Model:
    """``context`` has one more row, for what stands before a text."""

    context: np.ndarray
    places: np.ndarray
    groups: np.ndarray
    group_bias: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.context, self.places, self.groups, self.group_bias, self.output, self.bias

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    @classmethod
    def of(cls, flat: np.ndarray, starts: np.ndarray) -> Model:
        items, classes = int(starts[-1]), len(starts) - 1
        shapes = [(items + 1, WIDTH), (2, WIDTH), (classes, WIDTH), (classes,), (items, WIDTH), (items,)]
        cuts = np.cumsum([math.prod(x) for x in shapes])[:-1]
        # Copies, since parameters and squares are changed in place.
        return cls(*[x.reshape(shape).astype(np.float32) for x, shape in zip(np.split(flat, cuts), shapes)])

    @classmethod
    def start(cls, share: np.ndarray, starts: np.ndarray) -> Model:
        rng, items, classes = np.random.default_rng(7), len(share), len(starts) - 1

        def small(*shape: int) -> np.ndarray:
            return rng.normal(0, 0.1, shape).astype(np.float32)

        inside = np.add.reduceat(share, starts[:-1])
        return cls(
            small(items + 1, WIDTH),
            np.ones((2, WIDTH), np.float32),
            small(classes, WIDTH),
            np.log(inside).astype(np.float32),
            small(items, WIDTH),
            np.log(share / inside[class_of(starts)]).astype(np.float32),
        )

    def predicted(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """The vector that the two words before (the nearer first) lead to expect."""
        return self.context[near] * self.places[0] + self.context[far] * self.places[1]


def class_of(starts: np.ndarray) -> np.ndarray:
    """The class of each item."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def class_starts(share: np.ndarray) -> np.ndarray:
    """Where classes of about equal shares begin, of items by falling share."""
    number = math.ceil(math.sqrt(len(share)))
    middle = (np.cumsum(share) - share / 2) / share.sum()
    own = np.minimum((middle * number).astype(np.int64), number - 1)
    return np.concatenate([np.flatnonzero(np.diff(own, prepend=-1)), [len(share)]])


class Trainer:
    """Noise-contrastive estimation with per-parameter steps, in batches, on both levels.

    A token's class is told from noise classes drawn for the batch, the token from
    noise words drawn from its class. The state is the parameters and, behind them,
    their sums of squared gradients, so that a shard goes on with steps as small as
    those before it. Only rows that a batch touches are changed.
    """

    def __init__(self, state: np.ndarray, share: np.ndarray, starts: np.ndarray, seed: int) -> None:
        self.rng = np.random.default_rng(seed)
        self.model, squares = (Model.of(half, starts) for half in np.split(state, 2))
        self.squares = squares.parts()
        self.sums = [np.zeros(x.size, np.float32) for x in self.squares]  # all 0 between steps
        self.starts, self.classes = starts, class_of(starts)
        inside = np.add.reduceat(share, starts[:-1])
        self.below_class = np.cumsum(inside / inside.sum())
        self.log_class = np.log(inside / inside.sum() * NOISE).astype(np.float32)
        self.below = np.cumsum(share)
        self.inside = inside
        self.before = np.concatenate([[0.0], self.below])[starts[:-1]]
        self.log_noise = np.log(share / inside[self.classes] * INNER).astype(np.float32)
        self.tokens = 0

    @staticmethod
    def start(share: np.ndarray, starts: np.ndarray) -> np.ndarray:
        parameters = Model.start(share, starts).flat()
        return np.concatenate([parameters, np.full_like(parameters, CALM)])

    def state(self) -> np.ndarray:
        return np.concatenate([self.model.flat(), *[x.ravel() for x in self.squares]])

    def step(self, rows: np.ndarray, gradients: dict[int, np.ndarray]) -> None:
        """Change the ``rows`` of parameters, by their place among the parts, by the sums of their gradients."""
        touched = np.zeros(len(self.model.context), bool)
        touched[rows] = True
        own = np.flatnonzero(touched)
        for part, gradient in gradients.items():
            flat, width = self.sums[part], gradient[0].size
            cells = (rows[:, None] * width + np.arange(width)).ravel() if width > 1 else rows
            np.add.at(flat, cells, gradient.ravel())
            parameter, squares = self.model.parts()[part], self.squares[part]
            sums = flat.reshape(parameter.shape)[own]
            flat.reshape(parameter.shape)[own] = 0
            square = squares[own] + sums * sums
            squares[own] = square
            parameter[own] += STEP * sums / np.sqrt(square)

    def batch(self, near: np.ndarray, far: np.ndarray, word: np.ndarray) -> None:
        m, own = self.model, self.classes[word]
        expected = m.predicted(near, far)
        drawn = np.minimum(np.searchsorted(self.below_class, self.rng.random(NOISE)), len(m.group_bias) - 1)
        real = np.einsum("ij,ij->i", expected, m.groups[own]) + m.group_bias[own] - self.log_class[own]
        noise = expected @ m.groups[drawn].T + (m.group_bias[drawn] - self.log_class[drawn])
        up = 1 / (1 + np.exp(np.clip(real, -80, 80)))
        down = -1 / (1 + np.exp(-np.clip(noise, -80, 80)))
        at_expected = up[:, None] * m.groups[own] + down @ m.groups[drawn]
        class_rows = np.concatenate([own, drawn])
        class_grads = np.concatenate([up[:, None] * expected, down.T @ expected])
        class_bias = np.concatenate([up, down.sum(axis=0)])

        several = np.flatnonzero(np.diff(self.starts)[own] > 1)
        if len(several):
            inner, lead = own[several], expected[several]
            at = self.before[inner][:, None] + self.rng.random((len(several), INNER)) * self.inside[inner][:, None]
            low, high = self.starts[inner][:, None], self.starts[inner + 1][:, None] - 1
            items = np.concatenate([word[several][:, None], np.clip(np.searchsorted(self.below, at), low, high)], axis=1)
            vectors = m.output[items]
            score = np.einsum("nd,nkd->nk", lead, vectors) + m.bias[items] - self.log_noise[items]
            error = -1 / (1 + np.exp(-np.clip(score, -80, 80)))
            error[:, 0] += 1
            at_expected[several] += np.einsum("nk,nkd->nd", error, vectors)
            at_items = (error[:, :, None] * lead[:, None, :]).reshape(-1, WIDTH)
            self.step(items.ravel(), {4: at_items, 5: error.ravel()})
        in_place = [at_expected * m.places[0], at_expected * m.places[1]]
        places = np.stack([(at_expected * m.context[x]).sum(axis=0) for x in (near, far)])
        self.step(np.concatenate([near, far]), {0: np.concatenate(in_place)})
        self.step(np.arange(2), {1: places})
        self.step(class_rows, {2: class_grads, 3: class_bias})
        self.tokens += len(word)

    def train(self, near: np.ndarray, far: np.ndarray, word: np.ndarray) -> None:
        order = self.rng.permutation(len(word))
        for at in range(0, len(word), BATCH):
            own = order[at : at + BATCH]
            self.batch(near[own], far[own], word[own])


def token_indices(texts: list[str], head: Head) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Head index of every token (-1: not in the head), tokens per text, all tokens."""
    tokens: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    end = END.encode()
    for i, text in enumerate(texts):
        own = text.encode().lower().split()
        tokens += own
        tokens.append(end)
        counts[i] = len(own) + 1
    get = head.index.get
    return np.array([get(t, -1) for t in tokens], np.int64), counts, tokens


def item_runs(index: np.ndarray, counts: np.ndarray, head: Head) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items of the word before, of the one before that, and of each token itself."""
    own = (index >= 0) & (index < len(head.item))
    word = np.full(len(index), head.other, np.int64)
    word[own] = head.item[index[own]]
    place = np.arange(len(word)) - np.repeat(np.cumsum(counts) - counts, counts)
    near, far = np.roll(word, 1), np.roll(word, 2)
    near[place < 1] = len(head.share)
    far[place < 2] = len(head.share)
    return near, far, word


def chunks(texts: list[str], chars: int = CHUNK_CHARS) -> Iterator[list[str]]:
    own, size = [], 0
    for text in texts:
        own.append(text)
        size += len(text)
        if size >= chars:
            yield own
            own, size = [], 0
    if own:
        yield own


STATES = "shard int, tokens bigint, flat array<float>"


def state_row(shard: int, tokens: int, flat: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([shard], pa.int32()), pa.array([tokens], pa.int64()), pa.array([flat.astype(np.float32)], pa.list_(pa.float32()))]
    return pa.RecordBatch.from_arrays(columns, ["shard", "tokens", "flat"])


def in_shards(training: DataFrame, number: int) -> DataFrame:
    """The rows by shard, a function of their content alone, and in an order of their content."""
    shard = F.pmod("_k2", F.lit(number)).cast("int")
    dealt = training.select("_k1", "_k2", "_text", shard.alias("_shard")).repartitionById(number, "_shard")
    return dealt.sortWithinPartitions("_k1", "_k2").select("_shard", "_text")


def training_runs(docs: DataFrame, head, start, passes: int) -> DataFrame:
    """One row per task with text, which has one shard: its state after training on it, and its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, trainer, shard = Head(**head.value), None, 0
        for batch in batches:
            for own in chunks([t or "" for t in batch.column(1).to_pylist()]):
                if trainer is None:
                    shard = batch.column(0)[0].as_py()
                    trainer = Trainer(start, known.share, known.starts, 11)
                index, counts, _ = token_indices(own, known)
                runs = item_runs(index, counts, known)
                for _ in range(passes):
                    trainer.train(*runs)
        if trainer is not None:
            yield state_row(shard, trainer.tokens, trainer.state())

    return docs.mapInArrow(run, STATES)


def averaged(runs: DataFrame, start: np.ndarray) -> np.ndarray:
    """The mean of the shards' states, weighted by their tokens, in a tree of Spark tasks and in order of shards."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight, first = None, 0, 0
        for batch in batches:
            for shard, tokens, flat in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = flat.values.to_numpy().astype(np.float64) * tokens
                first = shard if total is None else first
                total, weight = (own if total is None else total + own), weight + tokens
        if weight:
            yield state_row(first, weight, total / weight)

    level = stage(runs, "lm-runs")
    number, width = level.count(), FAN_IN
    while number > 1:
        group = F.floor(F.col("shard") / width).cast("int")
        groups = level.agg(F.max(group) + 1).first()[0]
        dealt = level.repartitionById(groups, group).sortWithinPartitions("shard")
        level = stage(dealt.mapInArrow(merge, STATES), "lm-mean")
        number, width = level.count() if groups > 1 else 1, width * FAN_IN
    last = level.take(1)
    return np.array(last[0]["flat"]) if last else start


def count_tokens(training: DataFrame) -> DataFrame:
    """``token`` and ``c`` over all training texts, the end token included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in chunks([t or "" for t in batch.column(0).to_pylist()], COUNT_CHARS):
                found: Counter = Counter()
                for text in own:
                    found.update(text.encode().lower().split())
                found[END.encode()] = len(own)
                columns = [pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["token", "n"])

    parts = training.select("_text").mapInArrow(run, "token binary, n bigint")
    counts = parts.groupBy(F.col("token").cast("string").alias("token")).agg(F.sum("n").alias("c"))
    return stage(counts, "lm-counts")


def head_of(counts: DataFrame, total: int) -> Head:
    """The tokens with ``HEAD_SHARE`` of all tokens or more, the end first."""
    frequent = counts.filter(F.col("c") >= max(1.0, HEAD_SHARE * total)).toPandas()
    order = np.lexsort((frequent["token"], -frequent["c"], frequent["token"] != END))
    words, c = frequent["token"].to_numpy()[order], frequent["c"].to_numpy(np.int64)[order]
    least = max(1.0, HEAD_SHARE * total, min(MODEL_SHARE * total, MODEL_ROOT * math.sqrt(total)))
    own = int((c >= least).sum())
    outside = total - int(c[:own].sum())
    share = np.concatenate([c[:own], [max(outside, 1)]]).astype(float)
    by_share = np.argsort(-share, kind="stable")
    item = np.empty(own + 1, np.int64)
    item[by_share] = np.arange(own + 1)
    share = share[by_share] / share.sum()
    index = {w.encode(): i for i, w in enumerate(words)}
    return Head(index, np.log10(c + ADDED), item[:own], share, int(item[own]), class_starts(share), outside)


class Scorer:
    """Log-probabilities of items: that of the class times that of the item in it, each normalised exactly."""

    #: Scores that are held at a time.
    CELLS = 262_144

    def __init__(self, model: Model, starts: np.ndarray) -> None:
        self.model, self.starts, self.classes = model, starts, class_of(starts)

    def normalisers(self, expected: np.ndarray, vectors: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """The log of the sum over all ``vectors``, for each row."""
        out, size = np.empty(len(expected), np.float32), max(1, self.CELLS // len(bias))
        for at in range(0, len(expected), size):
            scores = expected[at : at + size] @ vectors.T + bias
            top = scores.max(axis=1)
            scores -= top[:, None]
            out[at : at + size] = np.log(np.exp(scores, out=scores).sum(axis=1)) + top
        return out

    def log10(self, near: np.ndarray, far: np.ndarray, word: np.ndarray) -> np.ndarray:
        m, side, own = self.model, len(self.model.context), self.classes[word]
        pairs, back = np.unique(near * side + far, return_inverse=True)
        expected = m.predicted(pairs // side, pairs % side)
        normal = self.normalisers(expected, m.groups, m.group_bias)
        lead = expected[back]
        score = np.einsum("ij,ij->i", lead, m.groups[own]) + m.group_bias[own] - normal[back]
        several = np.flatnonzero(np.diff(self.starts)[own] > 1)
        several = several[np.argsort(own[several], kind="stable")]
        inner = np.einsum("ij,ij->i", lead[several], m.output[word[several]]) + m.bias[word[several]]
        bounds = np.flatnonzero(np.diff(own[several], prepend=-1, append=-1))
        for at, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            group = own[several[at]]
            items = slice(self.starts[group], self.starts[group + 1])
            inner[at:end] -= self.normalisers(lead[several[at:end]], m.output[items], m.bias[items])
        score[several] += inner
        return score.astype(np.float64) / math.log(10)


def partial_scores(rows: DataFrame, head, model: np.ndarray) -> DataFrame:
    """Per text what the model and the head say, and its other tokens with their counts."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    scorers: list[Scorer] = []

    def compute(texts: list[str]) -> list:
        known = Head(**head.value)
        if not scorers:
            scorers.append(Scorer(Model.of(shared.value, known.starts), known.starts))
        index, counts, tokens = token_indices(texts, known)
        near, far, word = item_runs(index, counts, known)
        text_of = np.repeat(np.arange(len(texts)), counts)
        rows = len(texts)
        model_sum = np.bincount(text_of, scorers[0].log10(near, far, word), rows)
        in_head = index >= 0
        logs = np.zeros(len(index))
        logs[in_head] = known.logs[index[in_head]]
        outside = word == known.other
        tails: list[Counter] = [Counter() for _ in texts]
        for i in np.flatnonzero(~in_head).tolist():
            tails[text_of[i]][tokens[i].decode()] += 1
        return [
            counts,
            np.bincount(text_of, in_head, rows).astype(np.int64),
            np.bincount(text_of, outside, rows).astype(np.int64),
            np.bincount(text_of, logs, rows),
            model_sum + np.bincount(text_of, logs * outside, rows),
            pa.array([list(t.items()) for t in tails], pa.map_(pa.string(), pa.int64())),
        ]

    return map_texts(
        rows,
        ["doc_id", "_k1", "_k2", "held_out"],
        "_text",
        compute,
        "n_tokens bigint, n_head bigint, n_outside bigint, head_logs double, model_logs double, tail map<string,bigint>",
    )


def score_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Unigram and model log10-probabilities of each whole text.

    Columns: doc_id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score``. Rows whose crc32 of the id leaves 0 when divided by 10
    are held out. The model predicts a token from the two before, in two steps, its
    class among all classes and itself among the items of its class, each normalised
    over all of them. Every word that is frequent enough (``MODEL_SHARE``,
    ``MODEL_ROOT``) is an item with vectors of its own, however many there are; all
    other words are one item, inside which odds are those of the training counts. So probabilities add up to 1 over all
    words and one unknown.

    Word counts are made and joined by Spark. The parameters are warmed up on a small
    sample, then trained on every shard of the training texts and averaged by Spark, so
    the model has seen all training tokens. A text's shard and its place there follow
    from its content, and the number of shards from the number of tokens, so scores do
    not depend on how the input is split.

    Null texts are empty (the end token only), a null id counts as the empty string,
    repeated rows get equal scores, and an empty table gives no rows. Without
    training rows all scores are those of an unknown token. Other columns are not read.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        (F.crc32(name) % FOLDS == 0).alias("held_out"),
    ).select("*", *row_key(F.col("doc_id"), F.col("_text")))
    training = rows.filter("NOT held_out")
    counts = count_tokens(training)
    sums = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count(F.lit(1)).alias("v"),
        F.coalesce(F.sum(F.when(F.col("token") == END, F.col("c"))), F.lit(0)).alias("texts"),
    ).first()
    total, distinct = int(sums["n"]), int(sums["v"])
    own = head_of(counts, total)
    head = spark.sparkContext.broadcast(vars(own))

    share = min(1.0, WARM_TEXTS / max(int(sums["texts"]), 1))
    picked = training.filter(F.pmod("_k1", F.lit(1_000_000)) < math.ceil(share * 1_000_000))
    # All tasks scan; the few texts then go to one task, in an order of their own.
    sample = picked.repartition(1).sortWithinPartitions("_k1", "_k2").select(F.lit(0).alias("_shard"), "_text")
    start = Trainer.start(own.share, own.starts)
    warm = averaged(training_runs(sample, head, start, WARM_PASSES), start)
    # Shards by content, their number by the corpus: no score depends on files, splits or cores.
    shards = in_shards(training, max(1, math.ceil(total / SHARD_TOKENS)))
    model = np.split(averaged(training_runs(shards, head, warm, 1), warm), 2)[0]

    scored = stage(partial_scores(rows, head, model), "lm-partial")
    pairs = scored.select("_k1", "_k2", F.explode("tail").alias("token", "times"))
    log = F.log10(F.coalesce("c", F.lit(0)) + ADDED)
    said = pairs.join(counts, "token", "left").select(
        "_k1",
        "_k2",
        (F.col("times") * log).alias("logs"),
        F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0).alias("known"),
        F.lit(0).alias("rows"),
    )
    # Each row gives one mark besides its tail tokens, by which repeated rows are told apart.
    marks = scored.select("_k1", "_k2", F.lit(0.0).alias("logs"), F.lit(0).cast("long").alias("known"), F.lit(1).alias("rows"))
    tails = (
        said.unionByName(marks)
        .groupBy("_k1", "_k2")
        .agg(F.sum("logs").alias("logs"), F.sum("known").alias("known"), F.sum("rows").alias("rows"))
    )
    base_norm = math.log10(total + ADDED * (distinct + 1))
    rest_norm = math.log10(own.outside + ADDED * (distinct - len(own.item) + 1))
    tail_logs = F.col("logs") / F.col("rows")
    return scored.drop("tail").join(tails, ["_k1", "_k2"]).select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + (F.col("known") / F.col("rows")).cast("long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_logs") + tail_logs - F.col("n_tokens") * F.lit(base_norm)).alias("base_score"),
        (F.col("model_logs") + tail_logs - F.col("n_outside") * F.lit(rest_norm)).alias("score"),
    )
