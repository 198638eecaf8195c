"""Near copies, components, and benchmark passages, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquetry.llm import decontaminate as dc
from marquetry.llm import near_dups as nd
from marquetry.llm.components import components

from .helpers import LOREM, awkward, empty, linked_components, simhash, weighted

SF = "/root/testdata/sf0.001"


def signed(values: list[int]) -> list[int]:
    return np.array(values, np.uint64).view(np.int64).tolist()


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 130)] + [(5, i) for i in range(6, 30)] + [(50, 50), (41, 40), (40, 41)]
    got = {r["a"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(101, 131)} | {i: 5 for i in range(6, 30)} | {41: 40}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_all_links_of_fingerprints(spark):
    """Random balls, chains of four bits, a group without centre, far groups that touch once."""
    random.seed(2)

    def near(value: int, bits: int) -> int:
        for b in random.sample(range(64), bits):
            value ^= 1 << b
        return value

    prints = [random.getrandbits(64) for _ in range(150)]
    for size in (5, 60):
        centre = random.getrandbits(64)
        prints += [near(centre, random.randint(1, 5)) for _ in range(size)]
    chain = random.getrandbits(64)
    for _ in range(40):
        prints.append(chain)
        chain = near(chain, 4)
    for first, width in nd.SEGMENTS:  # exactly four bits, spread so that each segment matters
        value = random.getrandbits(64)
        prints += [value, value ^ (1 << first) ^ (0b111 << (first + 20) % 62)]
    prints += [0, 0, 1, (1 << 64) - 1]
    ids = list(range(1000, 1000 + len(prints)))
    rows = spark.createDataFrame(list(zip(ids, signed(prints))), "doc_id long, fp long")
    got = {r["fp"]: r["component"] for r in nd.fingerprint_components(rows).collect()}
    want = linked_components(ids, prints)
    assert [got[p] for p in signed(prints)] == want


def test_near_duplicates_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(200)
    rows = docs.collect()
    prints = [simhash(r["text"]) for r in rows]
    want = linked_components([r["doc_id"] for r in rows], prints)
    got = {r["doc_id"]: r for r in nd.near_duplicates(docs).collect()}
    assert [got[r["doc_id"]]["fp"] for r in rows] == signed(prints)
    assert [got[r["doc_id"]]["component"] for r in rows] == want


def test_near_duplicates_awkward(spark):
    rows = awkward(spark)
    held = [(r["doc_id"], r["text"]) for r in rows.collect()]
    want = linked_components([i for i, _ in held], [simhash(t) for _, t in held])
    got = nd.near_duplicates(rows).collect()
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted([(r["doc_id"], r["component"]) for r in got], key=key) == sorted(
        [(i, c) for (i, _), c in zip(held, want)], key=key
    )
    kept = nd.keep_one_of_each(rows)
    assert kept.columns == rows.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(want)) and {i for i in ids if i is not None} <= set(want)
    assert nd.near_duplicates(empty(spark)).collect() == []
    assert nd.keep_one_of_each(empty(spark)).collect() == []


def brute_matches(docs: list[tuple], items: list[tuple]) -> dict:
    found = {}
    cut = [(i, dc.WORD.findall((t or "").lower())) for i, t in items]
    for doc, text in docs:
        words = dc.WORD.findall((text or "").lower())
        for item, own in cut:
            n = len(own)
            if not n:
                continue
            width = min(5, n)
            wanted = [tuple(own[j : j + width]) for j in range(n - width + 1)]
            for p in range(len(words) - n + 1):
                window = words[p : p + n]
                s = weighted([tuple(window[j : j + width]) for j in range(n - width + 1)], wanted)
                if s >= 0.8:
                    best = found.get((doc, item), (0, 0, 0))
                    found[doc, item] = (*max(best[:2], (s, -p)), best[2] + 1)
    return {k: (s, -p, n) for k, (s, p, n) in found.items()}


def test_decontamination_against_brute_force(spark):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(random.choices(vocabulary, k=n))) for i, n in enumerate((40, 25, 60, 4, 1, 5, 7))]
    items += [(7, items[0][1]), (8, None), (9, " .. "), (None, " ".join(["same"] * 12))]

    def around(words: list[str]) -> str:
        return " ".join(random.choices(vocabulary, k=30) + words + random.choices(vocabulary, k=30))

    docs = []
    for item, text in items[:3]:
        words = text.split()
        docs.append(around(words))
        docs.append(around([w.upper() + "," for w in words]))
        for at in (0, 1, 2, len(words) // 2, len(words) - 1):
            changed = [*words[:at], "other", *words[at + 1 :]]
            docs.append(around(changed))
        docs.append(around(words[2:]))
        docs.append(around(words[:20] + ["x"] * 10 + words[20:]))
    docs += [around(items[3][1].split()), items[5][1], items[6][1] + " z", "same " * 30, "same " * 11, None, ""]
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {
        (r["doc_id"], r["item_id"]): (r["similarity"], r["start"], r["n_windows"])
        for r in dc.benchmark_matches(rows, benchmark).collect()
    }
    want = brute_matches(list(enumerate(docs)), items)
    assert got == want and len(want) > 20
    assert any(s < 1 for s, _, _ in want.values())
    left = {r["doc_id"] for r in dc.drop_contaminated(rows, benchmark).collect()}
    assert left == set(range(len(docs))) - {d for d, _ in want}


def test_decontamination_awkward(spark):
    rows = awkward(spark)
    benchmark = spark.createDataFrame([(1, LOREM, "x")], "item_id long, text string, _k1 string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.benchmark_matches(rows, benchmark).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)} or got == {(1, 1), (2, 1)}
    kept = dc.drop_contaminated(rows, benchmark)
    assert kept.columns == rows.columns and kept.count() == rows.count() - len(got)
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.benchmark_matches(rows, none).collect() == []
    assert dc.drop_contaminated(rows, none).count() == rows.count()
    assert dc.benchmark_matches(empty(spark), benchmark).collect() == []


def test_block_keys_meet_within_the_radius(spark):
    """Fingerprints that differ by the radius, spread evenly, share a block key."""
    a = 0x0123456789ABCDEF
    b = a ^ sum(0b11111 << 16 * i for i in range(3)) ^ (0b1111 << 48)
    assert (a ^ b).bit_count() == dc.RADIUS
    row = spark.createDataFrame([tuple(signed([b]))], "b long").select(dc.block_keys(F.col("b"))).first()
    assert len(set(row[0]) & set(dc.near_blocks(signed([a])[0]).tolist())) == 1


def test_items_cut_short_are_found_in_short_texts(spark):
    random.seed(9)
    own = [f"w{i}" for i in random.sample(range(1000), 50)]
    docs = [" ".join(own[:n]) for n in (49, 46, 42, 41, 10)] + [" ".join(own[6:]), " ".join(own[:22] + ["x"] + own[23:46])]
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(own)), (2, " ".join(own[:48]))], "item_id long, text string")
    found = dc.benchmark_matches(rows, benchmark, short_texts=True).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    want = {}
    for i, text in enumerate(docs):
        a = [tuple(text.split()[j : j + 5]) for j in range(len(text.split()) - 4)]
        for item, n in ((1, 50), (2, 48)):
            s = weighted(a, [tuple(own[j : j + 5]) for j in range(n - 4)])
            if s >= 0.8 and len(text.split()) < n:
                want[i, item] = s
    assert {k: v for k, v in got.items() if k in want} == pytest.approx(want)
    assert want[1, 1] == pytest.approx(42 / 46) and set(got) - set(want) <= {(0, 2)}
    left = {r["doc_id"] for r in dc.drop_contaminated(rows, benchmark, short_texts=True).collect()}
    assert left == set(range(len(docs))) - {d for d, _ in got}
