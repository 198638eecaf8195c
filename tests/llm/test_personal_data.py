"""Personal data: the counts, verdicts and spans of revealing words against brute force, and very long texts."""

from __future__ import annotations

import math
import random
import re
import time
from collections import defaultdict

import duckdb
import xxhash
from pyspark.sql import functions as F

from marquetry.llm import mixing, pii
from marquetry.llm.queries import ORACLES

from .test_rows import base_spans


def hashed(*parts: str) -> int:
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def bits(values) -> int:
    return len({v % pii.MASK_BITS for v in values})


def is_term(word: str) -> bool:
    return bool(re.search("[A-Za-z]", word)) and "@" not in word


def term(word: str) -> str:
    return re.sub("^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "", word).lower()


def forms(kind: str, value: str) -> list[str]:
    value = value.lower()
    general = {
        "email": lambda: value[value.index("@") :],
        "ip": lambda: value.rsplit(".", 1)[0] + ".*",
        "card": lambda: re.sub("[^0-9]", "", value)[:6] + "*",
        "phone": lambda: re.match(r"\+[0-9]{1,3}", value).group() + "*",
    }[kind]()
    return [f"{kind}:{value}", f"{kind}:{general}"]


def near_words(text: str, start: int, end: int) -> set[str]:
    first, out = max(start - pii.REACH - 1, 0), set()
    for left, part in ((True, text[first:start]), (False, text[end : end + pii.REACH + 1])):
        offset = 0
        for word in re.split(pii.SPACES, part):
            cut = left and first > 0 and offset == 0 or not left and offset + len(word) > pii.REACH
            touches = offset + len(word) == len(part) if left else offset == 0
            if is_term(word) and not cut and not touches:
                out.add(term(word))
            offset += len(word) + 1
    return out


def verdicts(texts: list[str]) -> dict[str, str]:
    """Each term's verdict, from all pairs of a term and an entity."""
    terms = [{term(w) for w in re.split(pii.SPACES, t) if is_term(w)} for t in texts]
    windows: list[dict] = []
    near: dict = defaultdict(lambda: (set(), set()))
    for i, text in enumerate(texts):
        own = defaultdict(set)
        for kind, start, end in base_spans(text):
            context = hashed(text[max(start - pii.REACH - 1, 0) : start], text[end : end + pii.REACH + 1])
            for form in forms(kind, text[start:end]):
                own[form].add(context)
                for word in near_words(text, start, end):
                    near[form, word][0].add(context)
                    near[form, word][1].add(i)
        windows.append(own)
    with_term, with_entity = defaultdict(set), defaultdict(set)
    for i in range(len(texts)):
        for t in terms[i]:
            with_term[t].add(i)
        for e in windows[i]:
            with_entity[e].add(i)
    total = len(texts)
    candidates = sum(len(d) > 1 for d in with_term.values()) * sum(len(d) > 1 for d in with_entity.values())
    found: dict[str, str] = {}
    for e, holders in with_entity.items():
        content = math.log2(total / len(holders))
        for t, own in with_term.items():
            common = holders & own
            if not common or content <= 0:
                continue
            apart = min(bits(min(windows[i][e]) for i in common), bits(min(map(hashed, terms[i])) for i in common))
            contexts = bits(near[e, t][0]) if (e, t) in near else 0
            met = min(max(apart, contexts), len(common))
            if met < 2:
                continue
            n = met + len(own) - len(common)
            p, square = met / n, pii.CERTAINTY**2
            lower = (p + square / (2 * n) - pii.CERTAINTY * math.sqrt(p * (1 - p) / n + square / (4 * n * n))) / (1 + square / n)
            mutual = math.log2(lower * total / len(holders))
            if mutual / content >= pii.GENERALISE_AT and met * mutual >= math.log2(candidates):
                verdict = pii.REMOVED if mutual / content >= pii.REMOVE_AT else pii.GENERALISED
                found[t] = max(found.get(t, ""), verdict)
    return found


def marked(text: str, found: dict[str, str]) -> list[tuple]:
    base, out, at = base_spans(text), [], 0
    for word in re.split(pii.SPACES, text):
        inside = any(a < at + len(word) and b > at for _, a, b in base)
        if is_term(word) and term(word) in found and not inside:
            out.append((found[term(word)], at, at + len(word)))
        at += len(word) + 1
    return sorted(out)


def corpus() -> tuple[list[str], set[str]]:
    """Prose of common and rare words; some words go with a person, a company's domain, a network or a country."""
    rng = random.Random(9)
    common, rare = [f"word{i}" for i in range(60)], [f"rare{i}" for i in range(400)]
    owners = {
        "quorn": lambda i: f"p{i}@quorn.example", "zelda": lambda i: "zelda@mail.example", "rackfour": lambda i: f"10.7.4.{i}",
        "tonga": lambda i: f"+676 {20_000_000 + i}", "platina": lambda i: "no:4111 1111 1111 1111;",
    }
    texts = []
    for i in range(400):
        words = rng.choices(common, k=rng.choice([6, 25, 60])) + rng.choices(rare, k=4)
        rng.shuffle(words)
        for name, entity in owners.items():
            if rng.random() < 0.03:
                words.insert(rng.randrange(len(words)), f"({name.title()})")
                words.insert(rng.randrange(len(words)), entity(i))
        if rng.random() < 0.1:
            words.insert(rng.randrange(len(words)), rng.choice([f"a{i}@mail.example", f"192.168.{i % 250}.9", f"+44 7700 90{i:04d}"]))
        texts.append(" ".join(words))
    return texts + ["Quorn was here", "copied by lone@x.example xyzzy", "copied by lone@x.example xyzzy"], set(owners)


def test_verdicts_and_spans_against_all_pairs(spark):
    texts, planted = corpus()
    found = verdicts(texts)
    assert planted <= set(found) and len(set(found) - planted) <= 1  # the planted words, and hardly one by chance
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: sorted((t["verdict"], t["start"], t["end"]) for t in r["terms"]) for r in pii.find_personal_data(rows.repartition(3)).collect()}
    for i, text in enumerate(texts):
        assert got[i] == marked(text, found), text
    assert got[400] and not got[401] and not got[402]


def test_the_general_form_gives_single_entities_support(spark):
    """Every address occurs once; only their domain recurs, and a word with it."""
    rng = random.Random(2)
    texts = [f"mail from n{i}@acme.example about acmecorp and {' '.join(rng.choices('abcdefgh', k=9))} {i}x" for i in range(8)]
    texts += [f"nothing but {' '.join(rng.choices('abcdefgh', k=9))} {i}y" for i in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.span_digests(rows).collect()}
    for i in range(8):
        start = texts[i].index("acmecorp")
        assert f"remove:{start}:{start + 8}" in spans[i] and spans[i].startswith("email:10:")
    assert not any(spans[i] for i in range(8, 208))


def test_contexts_are_counted_exactly(spark, monkeypatch):
    """More contexts than a word has bits, and two contexts that set the same bit."""
    rng = random.Random(4)

    def filler(n: int) -> str:
        return " ".join(f"pad{rng.randrange(100_000)}" for _ in range(n))

    texts = [f"quorn {filler(12)} at z@x.org {filler(12)}" for _ in range(150)]
    texts += [f"quorn {filler(12)}" for _ in range(80)] + [filler(14) for _ in range(1_700)]

    def bit(text: str) -> int:
        [(_, start, end)] = base_spans(text)
        return hashed(text[max(start - pii.REACH - 1, 0) : start], text[end : end + pii.REACH + 1]) % pii.MASK_BITS

    first = f"zorro {filler(14)} to u@y.net {filler(14)}"
    second = next(t for t in iter(lambda: f"zorro {filler(14)} to u@y.net {filler(14)}", "") if bit(t) == bit(first) and t != first)
    third = f"ulla {filler(14)} to v@w.net {filler(14)}"
    texts += [first, second, third, third]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: sorted((t["verdict"], t["start"], t["end"]) for t in r["terms"]) for r in pii.find_personal_data(rows).collect()}
    capped = verdicts(texts)
    monkeypatch.setitem(globals(), "bits", lambda values: len(set(values)))
    found = verdicts(texts)
    assert {"quorn", "zorro"} <= set(found) and not {"quorn", "zorro"} & set(capped) and "ulla" not in found
    for i, text in enumerate(texts):
        assert got[i] == marked(text, found), text


def test_very_many_addresses_in_one_text(spark):
    text = " ".join(f"u{i}@h{i % 97}.example" for i in range(200_000))
    rows = spark.createDataFrame([(1, text), (2, "plain")], "doc_id long, text string")
    started = time.time()
    got = rows.select("doc_id", pii.matches(F.col("text"), "email").alias("m"), F.col("text"))
    got = got.select("doc_id", F.size("m").alias("n"), F.try_element_at("m", F.lit(-1)).alias("last"), F.size(pii.contexts(F.col("text"), "email", F.col("m"))).alias("c"))
    found = {r["doc_id"]: r for r in got.where("doc_id = 1 or n = 0").collect()}
    assert found[1]["n"] == found[1]["c"] == 200_000 and found[2]["n"] == 0
    assert text[found[1]["last"]["start"] : found[1]["last"]["end"]] == "u199999@h82.example"
    assert time.time() - started < 60


def test_mixing_sql_with_large_rates(spark):
    """A source whose rate is far above that at which exp(-rate) is 0."""
    rows = [(i, "x" * 40, "big") for i in range(600)] + [(1000 + i, "ab", "small") for i in range(5)] + [(None, "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.sql(f"SELECT doc_id, copy, order_key FROM ({ORACLES['op5_mixing']})").fetchall()
    got = mixing.mix_sources(docs)
    assert got.filter("row.source = 'small'").count() > 5 * 745
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(map(tuple, got.select("row.doc_id", "copy", "order_key").collect()), key=key) == sorted(want, key=key)
