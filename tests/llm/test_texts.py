"""Quality rules, token counts and language-model scores."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marquetry.llm import lm, quality, tokens
from marquetry.llm.queries import VOCABULARY

from .helpers import awkward, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(words: list[str]) -> list[int]:
    """For each position the longest prefix that also starts elsewhere, by trying all."""
    n, depth = len(words), [0] * len(words)
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and words[i + k] == words[j + k]:
                k += 1
            depth[i], depth[j] = max(depth[i], k), max(depth[j], k)
    return depth


def spans(depth: list[int], least: int) -> int:
    inside = {q for p, d in enumerate(depth) if d >= least for q in range(p, p + d)}
    return len(inside)


def expected_quality(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    depth = repeats(words)
    lines, seen, copies = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for line in lines:
        copies += line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {q for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for q in range(i, i + 5)}
    n = len(words)
    failed = n < 10 or 100 * len(inside) > 20 * n
    share, longest = spans(depth, 8) / max(n, 1), max(depth, default=0)
    return (
        n,
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        copies,
        len(inside),
        failed,
        longest,
        share,
        not failed and share <= 0.15 and longest <= 50,
    )


def test_repetition_against_all_pairs(spark):
    random.seed(3)
    texts = [" ".join(random.choices("abc", k=n)) for n in (1, 9, 10, 40, 120)]
    texts += [" ".join(random.choices([f"w{i}" for i in range(300)], k=400)) for _ in range(3)]
    block = [f"r{i}" for i in range(60)]
    texts.append(" ".join([*block, *[f"m{i}" for i in range(900)], *block]))  # one long repeat
    texts += ["a b\na b\n\nc #|<> $%&*\n a b", "x y  z", None, "", "ü é\r\nü é"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.repetition_rules(rows).collect()}
    for i, text in enumerate(texts):
        want = expected_quality(text)
        assert got[i][:7] == want[:7] and got[i][8] == want[8], text
        assert got[i][7] == pytest.approx(want[7])
    assert not got[8][8] and not got[8][5]  # dropped by the suffix array alone


def test_quality_awkward(spark):
    rows = awkward(spark)
    got = quality.repetition_rules(rows).collect()
    assert len(got) == rows.count()
    long = next(r for r in got if r["doc_id"] == 7)
    assert (long["n_words"], long["n_repeat_words"], long["kept"]) == (40_001, 40_000, False)
    assert [r["base_failed"] for r in got if r["doc_id"] in (4, 5, 6)] == [True] * 3
    assert quality.repetition_rules(empty(spark)).collect() == []


def greedy(word: bytes, pieces: set[bytes]) -> int:
    count = at = 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in pieces:
                break
        else:
            return 1
        at, count = end, count + 1
    return count


def test_automaton_against_greedy():
    random.seed(5)
    for _ in range(300):
        pieces = {bytes(random.choices(b"abc", k=random.randint(1, 5))) for _ in range(random.randint(1, 12))}
        automaton = tokens.MatchAutomaton(pieces)
        for _ in range(30):
            word = bytes(random.choices(b"abc", k=random.randint(1, 12)))
            assert automaton.count(word) == greedy(word, pieces), (pieces, word)


def test_token_counts(spark):
    pieces = tokens.read_ranks(VOCABULARY)
    known = set(pieces)
    rows = awkward(spark)
    got = tokens.count_tokens(rows, pieces).collect()
    texts = [r["text"] or "" for r in rows.collect()]
    want = [
        (sum(greedy(b" " + w, known) for w in t.encode().split()), len(t.encode().split()), len(t))
        for t in texts
    ]
    assert sorted(tuple(r)[1:] for r in got) == sorted(want)
    assert tokens.count_tokens(empty(spark), pieces).collect() == []


def base_scores(rows: list) -> dict:
    counts: Counter = Counter()
    held = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, _ in rows}
    split = [(i, [*(t or "").encode().lower().split(), b"\n"]) for i, t in rows]
    for i, own in split:
        if not held[i]:
            counts.update(own)
    n, v = sum(counts.values()), len(counts)
    return {
        (i, len(own)): (held[i], len(own), sum(counts[t] > 0 for t in own), n,
            sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own))
        for i, own in split
    }


@pytest.mark.parametrize("share", [1e-6, 0.05])
def test_lm_base_and_awkward(spark, monkeypatch, share):
    """With a larger share almost all counts come by the join."""
    monkeypatch.setattr(lm, "HEAD_SHARE", share)
    rows = awkward(spark)
    got = lm.score_texts(rows).collect()
    want = base_scores([(r["doc_id"], r["text"]) for r in rows.collect()])
    assert len(got) == rows.count()
    for r in got:
        own = want[(r["doc_id"], r["n_tokens"])]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == own[:4]
        assert r["base_score"] == pytest.approx(own[4], abs=1e-6)
        assert math.isfinite(r["score"]) and r["score"] < 0
    assert lm.score_texts(empty(spark)).collect() == []


def test_lm_learns_order_on_held_out(spark):
    random.seed(1)
    after = {w: [f"{w}{k}" for k in range(3)] for w in "abcdefgh"}
    texts = [" ".join(f"{w} {random.choice(after[w])}" for w in random.choices("abcdefgh", k=60)) for _ in range(300)]
    got = lm.score_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    held = got.filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert held[0] > held[1] + 0.1 * held[2]


def test_lm_probabilities_sum_to_one():
    import numpy as np

    rng = np.random.default_rng(0)
    share = np.sort(rng.pareto(1, 40) + 0.01)[::-1]
    starts = lm.class_starts(share / share.sum())
    assert starts[0] == 0 and starts[-1] == 40 and 2 < len(starts) <= 8 and (np.diff(starts) > 0).all()
    flat = rng.normal(size=len(lm.Model.start(share, starts).flat()))
    scorer = lm.Scorer(lm.Model.of(flat, starts), starts)
    for near, far in ((40, 40), (2, 40), (0, 3)):
        words = np.arange(40)
        total = (10 ** scorer.log10(np.full(40, near), np.full(40, far), words)).sum()
        assert total == pytest.approx(1, abs=1e-4)


def test_lm_classes_have_about_equal_shares():
    import numpy as np

    share = 1 / np.arange(1, 10_001)
    share /= share.sum()
    starts = lm.class_starts(share)
    masses = np.add.reduceat(share, starts[:-1])
    assert 70 < len(starts) - 1 <= 100 and masses[np.diff(starts) > 1].max() < 0.021
    # What a token costs on average: all classes, and the items of its own.
    assert len(starts) - 1 + (masses * np.diff(starts)).sum() < 300


def test_vocabulary_grows_with_the_corpus(spark, monkeypatch):
    heads, own = [], lm.head_of
    monkeypatch.setattr(lm, "head_of", lambda counts, total: (heads.append(own(counts, total)), heads[-1])[1])
    for n in (200, 2_000):
        random.seed(n)
        words = [f"w{i}" for i in range(n)]
        docs = [(i, " ".join(random.choices(words, k=50))) for i in range(n // 5)]
        assert lm.score_texts(spark.createDataFrame(docs, "doc_id long, text string")).count() == len(docs)
    assert len(heads[0].item) > 180 and len(heads[1].item) > 1_800


def test_the_warm_up_sample_is_picked_by_all_tasks(spark, monkeypatch):
    """The scan under the sample keeps its tasks: there is a shuffle between it and the one training task."""
    plans, own = [], lm.training_runs

    def seen(docs, head, start, passes):
        plans.append((passes, docs._jdf.queryExecution().executedPlan().toString()))
        return own(docs, head, start, passes)

    monkeypatch.setattr(lm, "training_runs", seen)
    rows = [(i, f"alpha beta gamma{i % 3}") for i in range(40)] + [(40, "one two"), (40, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert lm.score_texts(docs).count() == len(rows)
    (warm,) = [plan for passes, plan in plans if passes == lm.WARM_PASSES]
    assert "Coalesce" not in warm and "SinglePartition" in warm


@pytest.mark.parametrize("shard_tokens", [4_000_000, 3_000])
def test_scores_do_not_depend_on_the_split(spark, monkeypatch, shard_tokens):
    """The same rows in 1 and 8 partitions, also with several shards and a tree of averages."""
    monkeypatch.setattr(lm, "SHARD_TOKENS", shard_tokens)
    monkeypatch.setattr(lm, "FAN_IN", 2)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").filter("length(text) < 3000")
    one, many = (
        {r["doc_id"]: r["score"] for r in lm.score_texts(docs.repartition(n)).select("doc_id", "score").collect()} for n in (1, 8)
    )
    assert len(one) > 100 and one == pytest.approx(many, rel=1e-6)


def test_scores_add_up_by_brute_force(spark, monkeypatch):
    """Each text's score from the trained arrays, token by token, over all classes and all items of one."""
    import numpy as np

    trained, own = [], lm.partial_scores
    monkeypatch.setattr(lm, "partial_scores", lambda rows, head, model: (trained.append((head.value, model)), own(rows, head, model))[1])
    monkeypatch.setattr(lm, "MODEL_SHARE", 0.02)
    monkeypatch.setattr(lm, "MODEL_ROOT", 100.0)
    random.seed(4)
    words = [f"w{i}" for i in range(40)]
    texts = [(i, " ".join(random.choices(words, [1 / (k + 1) for k in range(40)], k=random.choice([0, 3, 30])))) for i in range(60)]
    got = {r["doc_id"]: r["score"] for r in lm.score_texts(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    head, flat = trained[0]
    starts, items = head["starts"], head["item"]
    model, side = lm.Model.of(flat, starts), len(head["share"])
    counts = Counter(t for i, x in texts if zlib.crc32(str(i).encode()) % 10 for t in [*x.split(), lm.END])
    assert 5 < len(items) < 30 and len(starts) > 3
    outside = sum(c for t, c in counts.items() if head["index"][t.encode()] >= len(items))
    rest = outside + 0.1 * (len(counts) - len(items) + 1)
    for i, text in texts:
        near = far = side
        total = 0.0
        for token in [*text.split(), lm.END]:
            place = head["index"].get(token.encode(), -1)
            word = int(items[place]) if 0 <= place < len(items) else head["other"]
            lead = model.context[near] * model.places[0] + model.context[far] * model.places[1]
            group = int(np.searchsorted(starts, word, "right")) - 1
            for vectors, bias, at in (
                (model.groups, model.group_bias, group),
                (model.output[starts[group] : starts[group + 1]], model.bias[starts[group] : starts[group + 1]], word - starts[group]),
            ):
                logits = [float(lead @ v + b) for v, b in zip(vectors, bias)]
                total += (logits[at] - np.logaddexp.reduce(logits)) / math.log(10)
            if word == head["other"]:
                total += math.log10((counts[token] + 0.1) / rest)
            near, far = word, near
        assert got[i] == pytest.approx(total, abs=1e-3)
