"""The corpus pipeline: language, boilerplate, near copies, benchmark passages, mixture.

Each stage takes what the stage before kept and returns the columns of documents;
the last one adds ``copy`` and ``order_key``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquetry.llm import decontaminate, language, lines, mixing, near_dups
from marquetry.llm.common import read_table, unpack
from marquetry.sources.scratch import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return language.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand on many sites; n_chars is counted anew."""
    return lines.cleaned_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dups.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), short_texts=True)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in random order."""
    mixed = mixing.mix_sources(docs)
    return unpack(mixed, docs.columns, "row", ["copy", "order_key"])


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixture", mixture),
]

#: Fingerprints need a hash that the SQL engine lacks; the tests hold the result
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
