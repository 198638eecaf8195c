"""Ranked search, fill-in-the-middle and toxicity."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquetry.llm import infill, search, toxicity
from marquetry.llm.queries import QUERIES

from .helpers import awkward, empty

SF = "/root/testdata/sf0.001"
TERM = re.compile(search.TERM)
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(LOWER))


def best(docs: list, items: list, top: int = 20) -> list:
    """(item, rank, doc, score) by scoring every document for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, own in counted:
            m = 75 + (25 * own.total() * n_docs) // max(n_terms, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 12 * m))
                for t in terms(text) if own[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top])]
    return out


def found(spark, docs: list, items: list, **options) -> list:
    rows = search.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        **options,
    )
    return sorted(map(tuple, rows.collect()), key=repr)


@pytest.mark.parametrize("blocks", [100_000, 7])
def test_search_against_all_pairs(spark, monkeypatch, blocks):
    """Also with items in many blocks, with segments and waves of a few documents, and over 64 terms."""
    monkeypatch.setattr(search, "BLOCK_TERMS", blocks)
    random.seed(2)
    words = [f"w{i}" for i in range(150)] + ["É", "ß9", "日本"]
    odds = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(random.choices(words, odds, k=random.choice([0, 1, 5, 80])))) for i in range(150)]
    docs += [(1000, None), (None, "w1 w2 É"), (1001, "W1,w1;w1! é"), *[(2000 + i, "w3 w4 w5") for i in range(30)]]
    docs += [(7, "w3 w4 w5"), (7, "w3 w4 w5")]
    items = [(1, "w1 w5 w9 É"), (2, " ".join(random.choices(words, odds, k=300))), (3, None), (4, ""), (None, "w3 w3 W4")]
    items += [(2, "w0"), (2, "w0"), (5, "nowhere at all")]
    assert found(spark, docs, items) == sorted(best(docs, items), key=repr)


def test_segments_stop_early_and_lose_nothing():
    """Over many segments the best stay the best, and fewer documents are scored than hold a term."""
    rng = np.random.default_rng(4)
    n, vocabulary, top = 6_000, 40, 5
    weights = rng.integers(0, 9_000, vocabulary)
    held = [np.flatnonzero(rng.random(vocabulary) < 0.2) for _ in range(n)]
    rows = {
        "doc_id": pa.array(rng.permutation(n)),
        "n": pa.array([int(5 * len(h)) for h in held], pa.int64()),
        "terms": pa.array([h.tolist() for h in held], pa.list_(pa.int32())),
        "counts": pa.array([rng.integers(1, 4, len(h)).tolist() for h in held], pa.list_(pa.int64())),
    }
    table = pa.table(rows)
    scored, total = [], int(sum(rows["n"].to_pylist()))

    class Counting(search.Segment):
        def scores(self, chosen, *rest):
            scored.append(len(chosen))
            return super().scores(chosen, *rest)

    asked, repeats = [3, 7, 11, 30, 35], [1, 2, 1, 1, 1]
    got: list = []
    for start in range(0, n, 1_000):
        got = Counting(table.slice(start, 1_000), weights, n, total).improve(got, asked, repeats, top)
    every = []
    for doc, length, own, counts in zip(*(c.to_pylist() for c in table.columns)):
        m, tf = 75 + (25 * length * n) // total, dict(zip(own, counts))
        score = sum(r * int(weights[t]) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t, r in zip(asked, repeats) if t in tf)
        every.append((-score, False, doc))
    assert got == sorted(every)[:top]
    assert sum(scored) < 0.4 * sum(any(t in set(h) for t in asked) for h in map(np.ndarray.tolist, held))


def test_search_awkward(spark):
    rows = awkward(spark)
    docs = [(r["doc_id"], r["text"]) for r in rows.collect()]
    items = spark.createDataFrame([(1, "word end", "x"), (2, "é", "x"), (3, "alpha Alpha big", "x")], "item_id long, text string, `a b` string")
    got = search.search(rows, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = best(docs, [(r[0], r[1]) for r in items.collect()])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert search.search(empty(spark), items).collect() == []
    assert search.search(rows, items.limit(0)).collect() == []


UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def infilled(doc: int | None, text: str | None) -> tuple:
    text, digest = text or "", hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc, len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return doc, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infill_against_slices(spark):
    random.seed(6)
    texts = ["".join(random.choices("abZ é<>PSM\n😀", k=random.choice([1, 3, 40, 600]))) for _ in range(300)]
    texts += ["<P", "P>", "<<S>", "a<M>b", "<S<M", None, "", "x" * 5_000, "é" * 5_000]
    rows = spark.createDataFrame([*enumerate(texts), (None, "no id <"), (3, "again"), (3, "again")], "doc_id long, text string")
    made = infill.fill_in_middle(rows).withColumn("back", infill.restore(F.col("output"), F.col("form"))).collect()
    given = [tuple(r) for r in rows.collect()]
    assert sorted((tuple(r)[:6] for r in made), key=repr) == sorted((infilled(*r) for r in given), key=repr)
    assert sorted(r["back"] for r in made) == sorted(t or "" for _, t in given)
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}


def test_lanes_find_every_rank(monkeypatch):
    monkeypatch.setattr(infill, "PIECE", 7)
    random.seed(8)
    for n in (0, 1, 16, 17, 256, 257, 5_000):
        text = "".join(random.choices("abcdeé 9", k=n))
        units = UNIT.findall(text)
        widths = infill.unit_widths(text)
        assert widths.tolist() == list(map(len, units))
        lanes, ends = infill.Lanes(widths), np.concatenate([[0], np.cumsum(widths)]).tolist()
        for rank in {0, len(units), *random.choices(range(len(units) + 1), k=50)}:
            assert lanes.code_points_before(rank) == ends[rank]
        if n == 5_000:
            assert len(lanes.lanes) >= 3


def test_infill_awkward(spark):
    rows = awkward(spark)
    got = infill.infill_digests(rows).collect()
    want = [infilled(r["doc_id"], r["text"]) for r in rows.collect()]
    assert sorted(r["output_sha256"] for r in got) == sorted(hashlib.sha256(w[5].encode()).hexdigest() for w in want)
    assert infill.infill_digests(empty(spark)).collect() == []


def test_infill_of_ten_million_characters():
    text = "word, " * 1_700_000
    n, form, first, middle, output = infill.rearranged("4", text, 101, 0)
    assert (n, form, len(output)) == (5_100_000 // 3 * 3, "psm", len(text) + 9)
    assert output[3 : 3 + first] + output[len(output) - middle :] + output[6 + first : -middle - 3] == text


def test_gradients_against_differences():
    """Each weight's gradient against the difference of the loss when it moves."""
    rng = np.random.default_rng(3)
    net = toxicity.Network.start()
    for name in net.w:
        net.w[name] = net.w[name].astype(np.float64)
    table = np.concatenate([np.zeros((1, 2 * toxicity.GATES)), rng.normal(size=(6, 2 * toxicity.GATES))])
    windows = rng.integers(0, 7, (3, toxicity.WINDOW))
    windows[0, 5:] = 0
    d = rng.normal(size=3).astype(np.float32)
    x, mask = toxicity.laid_out(table, windows)
    logits, seen = net.forward(x, mask, keep=True)
    grads, d_x = net.backward(d, mask, seen)
    for name, grad in grads.items():
        flat = net.w[name].reshape(-1)
        for k in rng.choice(len(flat), min(4, len(flat)), replace=False):
            was, sides = flat[k], []
            for move in (0.01, -0.01):
                flat[k] = was + move
                sides.append(float(net.forward(x, mask)[0] @ d))
            flat[k] = was
            assert grad.reshape(-1)[k] == pytest.approx((sides[0] - sides[1]) / 0.02, abs=2e-3), name
    moved = x.copy()
    moved[3, 1, 5, 2] += 0.05
    assert d_x[3, 1, 5, 2] == pytest.approx(float((net.forward(moved, mask)[0] - logits) @ d) / 0.05, abs=2e-3)


def test_windows_overlap_and_cover():
    for n in (0, 1, 31, 32, 33, 48, 49, 200):
        got = toxicity.windows_of(np.arange(1, n + 1))
        assert set(got.ravel().tolist()) - {0} == set(range(1, n + 1))
        assert all(row[0] == 1 + toxicity.STRIDE * k for k, row in enumerate(got.tolist()) if n)


def toxic_corpus(spark, n: int = 500):
    """Clean prose of made-up words; a third has words of a set, or with a prefix, somewhere."""
    rng = random.Random(1)
    plain = ["".join(rng.choices("abcdeghil", k=rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words, bad = rng.choices(plain, k=rng.choice([5, 40, 150])), i % 3 == 0
        for _ in range(3 if bad else 0):
            tail = "".join(rng.choices("abcdegh", k=3))
            words.insert(rng.randrange(len(words)), rng.choice(["snorkus", "Plimfer", "quxor" + tail, "quxor" + tail]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus(spark)
    got = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in got if r["held_out"]]
    caught = [r["predicted"] for r in held if r["toxic"]]
    wrong = [r["predicted"] for r in held if not r["toxic"]]
    assert len(caught) > 30 and sum(caught) >= 0.9 * len(caught) and sum(wrong) <= 0.03 * len(wrong)
    again = toxicity.score_toxicity(docs.repartition(5), labels.repartition(2))
    assert {r["doc_id"]: r["score"] for r in again.collect()} == pytest.approx({r["doc_id"]: r["score"] for r in got}, abs=1e-4)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = toxic_corpus(spark, 200)
    turned = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(*named(docs, labels)) == toxicity.train(*named(docs, turned))


def named(docs, labels):
    return docs.select("doc_id", F.col("text").alias("_text")), labels


def test_toxic_passage_deep_in_a_long_text(spark):
    docs, labels = toxic_corpus(spark)
    calm = ("abc deg hil edge bade " * 5_000).strip()
    more = spark.createDataFrame([(9001, calm), (9002, calm + " snorkus plimfer quxorabc snorkus " + calm)], "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs.unionByName(more), labels).filter("doc_id > 9000").collect()}
    assert got == {9001: 0, 9002: 1}


def test_toxicity_awkward(spark):
    rows = awkward(spark)
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (8, 0, "x"), (9, 0, "x"), (3, None, "x"), (None, 1, "x"), (77, 1, "x")], "doc_id long, toxic int, `a b` string")
    got = toxicity.score_toxicity(rows, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    kept = got.collect()
    assert len(kept) == rows.count() and all(0 <= r["score"] <= 1 for r in kept)
    assert {r["score"] for r in toxicity.score_toxicity(rows, labels.limit(0)).collect()} == {0.5}
    assert toxicity.score_toxicity(empty(spark), labels).collect() == []


def test_queries_read_whole_tables(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert QUERIES["op12_fill_in_middle"](spark, SF).count() == n
    assert QUERIES["op13_toxicity"](spark, SF).count() == n
