"""The pipeline against a brute-force version, and the entry without the operators."""

from __future__ import annotations

import hashlib
import math
import shutil
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import corpus_pipeline as cp
from marquetry.llm import decontaminate as dc

from .helpers import SCHEMA, linked_components, simhash
from .test_near import brute_matches

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


def without_boilerplate(rows: list[dict], least: int = 10) -> list[dict]:
    sites, first = defaultdict(set), {}
    for r in rows:
        for at, line in enumerate(r["text"].split("\n")):
            if line.strip(" \t\n\x0b\x0c\r"):
                sites[line].add(r["source"])
                first[line] = min(first.get(line, (r["doc_id"], at)), (r["doc_id"], at))
    out = []
    for r in rows:
        kept = [
            line
            for at, line in enumerate(r["text"].split("\n"))
            if len(sites[line] - {None}) < least or first[line] == (r["doc_id"], at)
        ]
        text = "\n".join(kept)
        out.append(r | {"text": text, "n_chars": len(text)})
    return out


def poisson_copies(rows: list[dict]) -> list[tuple]:
    size = defaultdict(int)
    for r in rows:
        size[r["source"]] += len(r["text"])
    full = sum(v > 0 for v in size.values())
    out = []
    for r in rows:
        rate = 1.0 * sum(size.values()) / full / size[r["source"]] if size[r["source"]] else 0.0
        u = int(hashlib.md5(f"0|{r['doc_id']}".encode()).hexdigest()[:13], 16) / 16**13
        k, term = 0, math.exp(-rate)
        total = term
        while total <= u:
            k += 1
            term = term * rate / k
            total += term
        for copy in range(1, k + 1):
            key = hashlib.md5(f"order0|{r['doc_id']}|{copy}".encode()).hexdigest()
            out.append((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], copy, key))
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs += [
        {"doc_id": 9001 + i, "text": t, "lang": "en", "source": "src1", "n_chars": len(t)} for i, t in enumerate(("", "123 ---", "99"))
    ]
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    spark.createDataFrame([tuple(d[n] for n in names) for d in docs], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))

    rows = [d for d in docs if any(c.isalpha() for c in d["text"])]
    rows = without_boilerplate(rows)
    component = linked_components([r["doc_id"] for r in rows], [simhash(r["text"]) for r in rows])
    rows = [r for r, c in zip(rows, component) if r["doc_id"] == c]
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    shared = {tuple(w[i : i + 5]) for _, t in items for w in [dc.WORD.findall(t.lower())] for i in range(len(w) - 4)}

    def suspicious(text: str) -> bool:
        w = dc.WORD.findall(text.lower())
        return any(tuple(w[i : i + 5]) in shared for i in range(len(w) - 4))

    leaks = {d for d, _ in brute_matches([(r["doc_id"], r["text"]) for r in rows if suspicious(r["text"])], items)}
    assert leaks
    want = poisson_copies([r for r in rows if r["doc_id"] not in leaks])

    got = [tuple(r) for r in cp.run(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixture"]
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_entry_without_the_operators(tmp_path):
    """The rest of the library imports and lists its queries when the folders are gone."""
    for name in ("__spark_entry__.py", "marquetry"):
        source = REPO / name
        copy = shutil.copytree if source.is_dir() else shutil.copy
        copy(source, tmp_path / name)
    shutil.rmtree(tmp_path / "marquetry" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'build_gold' in q and 'pipeline' not in q and set(q) == set(e.oracle_sql())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
