"""Language identification: the whole fusion by hand, accuracy, and awkward rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquetry.llm import language as lang

from .helpers import SCHEMA, awkward, empty

SF = "/root/testdata/sf0.01"


def by_hand(rows: list[tuple]) -> dict:
    """(id, text, declared, address) to (language, posterior), step by step in numpy."""
    declared = {i: (d or "").lower().split("-")[0] or None for i, _, d, _ in rows}
    names = sorted({d for d in declared.values() if d})
    n = len(names)
    counts = np.full((lang.BUCKETS, n), 0.5)
    for i, text, _, _ in rows:
        if declared[i]:
            np.add.at(counts[:, names.index(declared[i])], lang.run_codes(text), 1)
    model = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    scores, hosts, suffixes = {}, {}, {}
    for i, text, _, address in rows:
        codes = lang.run_codes(text)
        scores[i] = model[codes].astype(float).sum(axis=0) * min(1, lang.FULL_RUNS / max(len(codes), 1))
        host = address.split("://")[-1].split("/")[0].lower() if address else None
        hosts[i], suffixes[i] = host, host.rsplit(".", 1)[1] if host and "." in host else None
    shown = {i: int(np.argmax(s)) for i, s in scores.items()}

    def tally(keep) -> np.ndarray:
        return np.bincount([shown[i] for i in shown if keep(i)], minlength=n).astype(float)

    whole = (tally(lambda i: True) + 1.0 / n) / (len(rows) + 1)
    out = {}
    for i in scores:
        total = scores[i].copy()
        for value, right in ((declared[i], lang.DECLARED_RIGHT), (suffixes[i], lang.SUFFIX_RIGHT)):
            if value in names:
                total += np.log([right if value == x else (1 - right) / (n - 1) for x in names])
        if hosts[i]:
            above = whole
            if suffixes[i]:
                own = tally(lambda j: suffixes[j] == suffixes[i])  # noqa: B023
                above = (own + lang.SUFFIX_WEIGHT * whole) / (own.sum() + lang.SUFFIX_WEIGHT)
            own = tally(lambda j: hosts[j] == hosts[i])  # noqa: B023
            total += np.log((own + lang.HOST_WEIGHT * above) / (own.sum() + lang.HOST_WEIGHT))
        p = np.exp(total - total.max())
        out[i] = (names[int(np.argmax(total))], p.max() / p.sum())
    return out


def test_fusion_by_hand(spark):
    rows = [
        (1, "the cat and the dog", "en", "http://a.com/x"),
        (2, "the house of the rising sun", "en-US", "https://a.com"),
        (3, "der hund und die katze", "de", "http://b.de/q?x#y"),
        (4, "das haus und der garten", "DE", "b.de"),
        (5, "haus", None, "http://c.de/1"),
        (6, "hund", "en", "src1"),
        (7, "le chien et le chat", "fr", None),
        (8, "x", None, "a.com"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in lang.identify_languages(docs).collect()}
    for i, (name, posterior) in by_hand(rows).items():
        assert got[i]["language"] == name
        assert got[i]["posterior"] == pytest.approx(posterior, rel=1e-4)


def test_accuracy_without_declared_language(spark):
    """Half of the labels are hidden; the hidden ones are told from text and host alone."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    hidden = docs.withColumn("truth", F.col("lang")).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    got = lang.identify_languages(hidden).join(hidden.filter("doc_id % 2 = 1").select("doc_id", "truth"), "doc_id")
    right, kept, n = got.agg(F.sum((F.col("language") == F.col("truth")).cast("int")), F.sum(F.col("kept").cast("int")), F.count("*")).first()
    assert right >= 0.98 * n and kept >= 0.98 * n


def test_a_wrong_label_does_not_win(spark):
    rows = [(i, "the and of that with from this have been were", "en", "a") for i in range(20)]
    rows += [(i, "der die das und nicht mit von den auch sich", "de", "b") for i in range(20, 40)]
    rows += [(40, "the and of that with from this have been were", "de", "b")]
    got = lang.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert got.filter("doc_id = 40").first()["language"] == "en"


def test_language_awkward(spark):
    rows = awkward(spark)
    got = lang.identify_languages(rows).collect()
    assert len(got) == rows.count()
    assert not any(r["kept"] for r in got if r["doc_id"] in (4, 5, 6))
    kept = lang.keep_identified(rows)
    assert kept.columns == rows.columns and {1, 2, 3, 7, 8, 9} <= {r["doc_id"] for r in kept.collect()}
    assert lang.identify_languages(empty(spark)).collect() == []
    unlabelled = spark.createDataFrame([(1, "words", None, None, 1)], SCHEMA)
    assert [tuple(r)[3:] for r in lang.identify_languages(unlabelled).collect()] == [(None, None, None, False)]


def test_texts_of_other_languages_are_rejected(spark):
    random.seed(1)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")

    def words(letters: str, n: int, k: int) -> str:
        return " ".join("".join(random.choices(letters, k=k)) for _ in range(n))

    other = {
        -1: "Это обычный текст на русском языке, который не относится ни к одному из объявленных языков. " * 4,
        -2: "这是一个中文文本它不属于任何已声明的语言应该被拒绝我们用它来测试模型的拒绝能力" * 5,
        -3: "To jest zwykły tekst w języku polskim, który nie należy do żadnego z zadeklarowanych języków i powinien "
        "zostać odrzucony przez model, ponieważ wcale do nich nie pasuje. " * 3,
        -4: words("bcdfghjklmnpqrstvwxz", 100, 6),
        -5: words("0123456789abcdef", 40, 32),
    }
    rows = [(i, t, lang_, "src1") for i, t in other.items() for lang_ in (None, "en")]
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = lang.identify_languages(docs.unionByName(more)).collect()
    assert not any(r["kept"] for r in got if r["doc_id"] < 0) and len(got) == docs.count() + 10
    assert all(r["kept"] for r in got if r["doc_id"] >= 0)


def test_a_rare_language_is_a_language(spark):
    """On under a thousandth of the rows, but on LEAST_ROWS of them; sampled densely enough to be fitted."""
    names = "doc_id long, text string, lang string, source string"
    base = spark.range(150_000).select(
        F.col("id").alias("doc_id"), F.lit("the and of that with from this have been were").alias("text"),
        F.lit("en").alias("lang"), F.lit("a").alias("source"),
    )
    rare = [(-1 - i, "der die das und nicht mit von den auch sich", "de", "b") for i in range(lang.LEAST_ROWS)]
    got = lang.identify_languages(base.unionByName(spark.createDataFrame(rare, names)), train_rows=1_000)
    assert {(r["language"], r["kept"]) for r in got.filter("doc_id < 0").collect()} == {("de", True)}
