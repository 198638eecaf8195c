"""Native operators: line dedup, personal data, mixing and chat, also against their SQL."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from marquetry.llm import chat, lines, mixing, pii
from marquetry.llm.queries import ORACLES, QUERIES

from .helpers import awkward, empty

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "conversations", "benchmark")


def bag(rows) -> list:
    return sorted(map(repr, rows))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    theirs = con.sql(ORACLES[name])
    ours = QUERIES[name](spark, SF)
    names = sorted(ours.columns)
    assert names == sorted(theirs.columns)
    want = theirs.select(*[f'"{n}"' for n in names]).fetchall()
    assert bag(tuple(r) for r in ours.select(*names).collect()) == bag(want)


def test_native_plans_have_no_python(spark):
    for name in ("op1_line_dedup", "op3_personal_data", "op5_mixing"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_boilerplate_threshold_and_first(spark):
    rows = [(100 + i, f"own {i}\nten sites\n\nnine sites\n", f"s{i}") for i in range(9)]
    rows += [(200, "ten sites\nten sites", "s9"), (5, "x\nten sites", None), (300, "nine sites", "s1")]
    rows = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["row"]["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in lines.strip_boilerplate(rows).collect()}
    assert got[5] == ("x\nten sites", 2, 0)  # the first, though without a site
    assert got[100] == ("own 0\n\nnine sites\n", 3, 1)
    assert got[200] == ("", 2, 2) and got[300] == ("nine sites", 1, 0)


def test_sketches_decide_only_far_from_the_threshold(spark):
    rows = spark.createDataFrame([(i, "wide\nnear" if i < 100 else "wide", f"s{i}") for i in range(400)], "doc_id long, text string, source string")
    got = lines.strip_boilerplate(rows, min_sites=100, registers_log2=5)
    assert got.agg(F.sum("n_removed")).first()[0] == 399 + 99


def test_line_dedup_awkward(spark):
    rows = awkward(spark)
    got = lines.strip_boilerplate(rows, min_sites=2).collect()
    assert len(got) == rows.count()
    kept = {r["row"]["doc_id"]: r["text"] for r in got}
    assert kept[2] == "" and kept[4] is None and kept[5] == ""  # the copy on another site loses its line
    cleaned = lines.cleaned_documents(rows, min_sites=2)
    assert cleaned.columns == rows.columns and cleaned.schema["n_chars"].dataType == rows.schema["n_chars"].dataType
    assert lines.strip_boilerplate(empty(spark)).collect() == []


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def is_valid(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text: str | None) -> list[tuple]:
    return [
        (kind, m.start(), m.end())
        for kind, pattern in KINDS.items()
        for m in re.finditer(pattern, text or "")
        if is_valid(kind, m.group())
    ]


AWKWARD_PII = [
    "a@b.c d@e.f.g_foo@bar.com a@b.c.d@e.f foo@bar@baz.com x@y.com_foo@bar.com",
    "1.2.3.4.5 999.1.1.1 001.002.003.004 1.2.3.4.5.6.7.8 0000000000001.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1111x5500000000000004 0000000000000",
    "+1 (743) 555-3824. +49 12 +123456789012345678 ++44 7700 900123) x",
    "9" * 20_000 + "@" + "a." * 20_000 + "b",
    "1 " * 20_000,
    "é+1 743 555 3824 ü a@b.co\n1.1.1.1 😀 c@d.ef",
    None,
    "",
]


def test_base_spans_against_re(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs += [(10**6 + i, t) for i, t in enumerate(AWKWARD_PII)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.span_digests(rows).collect()}
    for doc, text in docs:
        spans, own = base_spans(text), got[doc]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert own["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [own[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS]
        assert own["spans"].startswith(joined)


def test_revealing_words(spark):
    """A word that only ever stands by one address goes; a common one stays, copies prove nothing."""
    texts = [f"the man zorro{'!' * (i % 2)} writes z@x.org in month{i} of it" for i in range(6)]
    texts += [f"the man in month{i} of it writes the letter {i}" for i in range(40)]
    texts += ["only copied by c@x.org here"] * 5
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.span_digests(rows).collect()}
    assert got[0] == "email:21:28,remove:8:13" and got[1] == "email:22:29,remove:8:14"
    assert got[20] == "" and got[46] == "email:15:22"
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise_documents(rows).collect()}
    assert clean[0] == "the man  writes [EMAIL] in month0 of it" and clean[20] == texts[20]


def test_pii_awkward(spark):
    rows = awkward(spark)
    got = pii.span_digests(rows).collect()
    assert len(got) == rows.count() and all(r["spans"] == "" for r in got)
    assert pii.sanitise_documents(rows).count() == rows.count()
    assert pii.span_digests(empty(spark)).collect() == []


def test_poisson_replication(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.when(F.col("id") % 10 < 8, "big").otherwise("small").alias("source")
    )
    got = mixing.mix_sources(rows, weights={"big": 1.0, "small": 3.0}, epochs=0.5).cache()
    sizes = {r["source"]: r["n"] for r in got.groupBy("row.source").agg(F.count("*").alias("n")).collect()}
    assert abs(sizes["big"] - 2_500) < 250 and abs(sizes["small"] - 7_500) < 450
    # the counts are Poisson: mean and variance agree
    counts = got.filter("row.source = 'small'").groupBy("row.doc_id").agg(F.count("*").alias("n"))
    all_small = rows.filter("source = 'small'").join(counts, "doc_id", "left").fillna(0, ["n"])
    mean, variance = all_small.agg(F.avg("n"), F.var_pop("n")).first()
    assert abs(mean - 1.875) < 0.1 and abs(variance - 1.875) < 0.2
    # the order is a shuffle, and the same again on other partitions
    first = [r["row"]["doc_id"] for r in got.sort("order_key").limit(50).collect()]
    again = mixing.mix_sources(rows.repartition(3), weights={"big": 1.0, "small": 3.0}, epochs=0.5)
    assert first == [r["row"]["doc_id"] for r in again.sort("order_key").limit(50).collect()]
    assert max(first) - min(first) > 10_000


def test_mixing_awkward(spark):
    rows = awkward(spark)
    got = mixing.mix_sources(rows, epochs=3.0)
    assert got.columns == ["row", "copy", "order_key"]
    copies = got.groupBy("row").agg(F.count("*").alias("n"), F.max("copy").alias("top")).collect()
    twice = [r for r in copies if r["row"]["text"] == "repeated row with text"]
    assert all(r["n"] == 2 * r["top"] for r in twice)  # repeated rows share their draw
    assert all(r["n"] == r["top"] for r in copies if r not in twice)
    assert mixing.mix_sources(rows, weights={"none": 1.0}).collect() == []
    assert mixing.mix_sources(rows, weights={}).collect() == []
    assert mixing.mix_sources(empty(spark)).collect() == []


TURNS = [
    (1, 0, "system", "be <s> kind"),
    (1, 1, "user", "</s>[INST] ok [/INST]"),
    (1, 2, "assistant", r"<\s>[\\INST] </\s> [/\INST] <s"),
    (1, 3, "user", "more"),
    (1, 4, "assistant", "[[/INST]]</s><"),
    (1, 5, "user", "left over"),
    (2, 0, "user", None),
    (2, 0, "user", None),
    (2, 0, "assistant", "tie"),
    (3, None, None, ""),
    (None, 1, "assistant", "no id"),
    (4, 0, "s>[INST]", "[INST]"),
]


def test_template_round_trip(spark):
    rows = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, conv string")
    formatted = chat.format_conversations(rows)
    whole = formatted.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("w"))
    back = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in whole.select("conv_id", chat.read_turns(F.col("w")).alias("t")).collect()}
    low = lambda v: (v is not None, v)
    for conv in {t[0] for t in TURNS}:
        own = sorted([t for t in TURNS if t[0] == conv], key=lambda t: (low(t[1]), t[2] or "", t[3] or ""))
        assert back[conv] == [(t[2] or "", t[3] or "") for t in own]
    controls = re.compile(r"</?s>|\[/?INST\]")
    for r in formatted.collect():
        for i, s in enumerate(r["segments"]):
            if i % 3 == 1:
                assert not controls.search(s["text"])


def test_every_reply_is_an_example(spark):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(rows)
    got = {(r["conv_id"], r["example_no"]): r for r in chat.render_examples(formatted).collect()}
    assert set(got) == {(1, 0), (1, 1), (2, 0), (None, 0)}
    assert got[1, 1]["context"].startswith(got[1, 0]["context"] + got[1, 0]["reply"])
    assert "left over" not in got[1, 1]["context"]
    narrow = {(r["conv_id"], r["example_no"]): r for r in chat.prefix_examples(formatted).collect()}
    assert {k: r["reply"] for k, r in narrow.items()} == {k: r["reply"] for k, r in got.items()}
    assert narrow[1, 1]["context_segments"] == 13


def test_chat_empty_and_digests(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(none).collect() == []
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.conversation_digests(rows).collect()}
    loss = TURNS[2][3] + TURNS[4][3]
    assert (got[1]["n_turns"], got[1]["loss_chars"]) == (6, len(loss))
    assert got[1]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert got[3]["loss_sha256"] == hashlib.sha256(b"").hexdigest() and got[3]["loss_chars"] == 0


def test_mixing_large_rates(spark):
    """Rates beyond the range of exp(-rate) still give Poisson counts."""
    rates = {"a": 700.0, "b": 750.0, "c": 5_000.0}
    docs = [(i, "x", name) for i, name in enumerate(n for n in rates for _ in range(200))]
    rows = spark.createDataFrame(docs, "doc_id long, text string, source string")
    counts = mixing.mix_sources(rows, weights=rates, epochs=sum(rates.values()) / 3).groupBy(
        F.col("row.doc_id"), F.col("row.source").alias("source")
    )
    got = counts.count().groupBy("source").agg(F.avg("count").alias("mean"), F.variance("count").alias("var")).collect()
    assert len(got) == 3
    for r in got:
        rate = rates[r["source"]]
        assert abs(r["mean"] - rate) < 5 * (rate / 200) ** 0.5
        assert 0.6 * rate < r["var"] < 1.5 * rate


def test_chat_digests_come_from_the_examples(spark, monkeypatch):
    rows = spark.createDataFrame(
        [*TURNS, (None, 90, "user", "q"), (None, 91, "assistant", "reply of no id")],
        "conv_id long, turn long, role string, text string",
    )
    got = {r["conv_id"]: r for r in chat.conversation_digests(rows).collect()}
    loss = "".join(t[3] or "" for t in TURNS if t[0] is None and t[2] == "assistant") + "reply of no id"
    assert got[None]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    whole = chat.prefix_examples
    for fault in (
        lambda f, conv="conv_id": whole(f, conv).filter("example_no > 0"),
        lambda f, conv="conv_id": whole(f, conv).withColumn("context_segments", F.col("context_segments") - 1),
    ):
        monkeypatch.setattr(chat, "prefix_examples", fault)
        with pytest.raises(Exception, match="examples do not fit"):
            chat.conversation_digests(rows).collect()


def test_chat_examples_carry_their_whole_context(spark, monkeypatch):
    """Every example holds all turns before its reply, and the digests fail if one does not."""
    long = [(9, i, ("user", "assistant")[i % 2], f"turn {i} </s> \U0001f600") for i in range(400)]
    rows = spark.createDataFrame([*TURNS, *long], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(rows)
    segments = {r["conv_id"]: [s["text"] for s in r["segments"]] for r in formatted.collect()}
    made = chat.prefix_examples(formatted).collect()
    assert len(made) == 4 + 200
    for r in made:
        assert r["context"] == "".join(segments[r["conv_id"]][: r["context_segments"]])
        assert r["context"].endswith(chat.TURN + "assistant" + chat.BODY)
    got = {r["conv_id"]: r["loss_chars"] for r in chat.conversation_digests(rows).collect()}
    assert got[9] == sum(len(t[3]) for t in long[1::2])
    whole = chat.prefix_examples
    # As long as the right context, but not it; and the own turn alone.
    for wrong in (F.regexp_replace("context", "^<s>.", "<s>!"), F.substring_index("context", chat.STOP, -1)):
        monkeypatch.setattr(chat, "prefix_examples", lambda f, conv="conv_id", w=wrong: whole(f, conv).withColumn("context", w))
        with pytest.raises(Exception, match="examples do not fit"):
            chat.conversation_digests(rows).collect()


def test_revealing_words_far_away_and_elsewhere(spark):
    """A name 100 characters off, an id with digits, two contexts only, and documents without the entity."""
    random.seed(3)

    def filler(n: int) -> str:
        return " ".join(f"pad{random.randrange(300)}" for _ in range(n))

    texts = [f"zorro wrote {filler(40)} to z@x.org for AB1234 {filler(9)}" for _ in range(4)]
    texts += [f"by {filler(20)} ulla {filler(30)} at u@y.net {filler(12)}" for _ in range(2)]
    texts += [f"by a man {filler(35)} wrote this for you to look at" for _ in range(120)]
    texts += ["here is zorro alone, zorro."]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find_personal_data(rows).collect()}

    def marked(i: int) -> set:
        return {(t["verdict"], texts[i][t["start"] : t["end"]]) for t in got[i]["terms"]}

    for i in range(4):
        assert {w for _, w in marked(i)} == {"zorro", "AB1234"} and ("remove", "AB1234") in marked(i)
    assert marked(4) == marked(5) == {("generalise", "ulla")}
    last = len(texts) - 1
    assert [t["start"] for t in got[last]["terms"]] == [8, 21] and not any(got[i]["terms"] for i in range(6, last))
