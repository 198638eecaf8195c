"""Language of a text by Bayesian fusion of its letters, declared language, address and host."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.sources.scratch import stage

from .common import map_texts, row_key, unpack, whole_row

#: Buckets of hashed runs of one to three letters, so the model has a fixed size per language.
BUCKETS = 1 << 14
#: About so many labelled rows are used to fit the letter model; all other counts cover all rows.
TRAIN_ROWS = 20_000
#: A label is a language of the corpus on so many rows, however large that is, or in a small
#: corpus on this share of the labelled rows.
LEAST_ROWS, LEAST_SHARE = 100, 0.001
#: About so many rows of each language at least are used to fit its letters, if there are as many.
LEAST_TRAIN_ROWS = 500
#: Runs of letters that count in full; the evidence of a longer text is scaled down to
#: as many, since neighbouring runs are not independent.
FULL_RUNS = 200
#: How often a declared language is right, and what a language's own part of addresses says.
DECLARED_RIGHT, SUFFIX_RIGHT = 0.9, 0.6
#: Rows that the level above weighs in the prior of a host, and of an address suffix.
HOST_WEIGHT, SUFFIX_WEIGHT = 20.0, 50.0
#: A text is rejected if its best language is less likely than this, or if it has no letter.
LEAST_POSTERIOR = 0.5
#: A text is of no known language if its mean log-likelihood a run is so many standard errors
#: (of its runs, ``FULL_RUNS`` at most) below what each language has on text that it was not fitted to.
LEAST_FIT = -18.0
#: No language is held to a smaller standard deviation, as one with hardly any text would have.
LEAST_SPREAD = 0.1


def run_codes(text: str) -> np.ndarray:
    """Bucket numbers of all runs of one to three characters inside the words of a text.

    Other characters than letters end a run; a word carries a mark before and after.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.uint64)
    letter = letters(points)
    points = np.where(letter, points, 32)
    if not len(points):
        return np.zeros(0, np.int64)
    padded = np.concatenate([[np.uint64(32)], points, [np.uint64(32)]])
    here, after = padded[:-1], padded[1:]
    keep = (here != 32) | (after != 32)
    two = (here * np.uint64(1_000_003) + after + np.uint64(1))[keep]
    one = points[letter]
    middle = letter  # a run of three is centred on a letter
    three = (padded[:-2] * np.uint64(999_983) + padded[1:-1]) * np.uint64(1_000_033) + padded[2:]
    codes = np.concatenate([one, two, three[middle]])
    codes = (codes ^ (codes >> np.uint64(15))) * np.uint64(0x9E3779B97F4A7C15)
    return (codes >> np.uint64(50)).astype(np.int64)


def letters(points: np.ndarray) -> np.ndarray:
    """Letters: a to z, and all characters from U+00C0 on but signs and punctuation."""
    ascii_letter = (points >= 97) & (points <= 122)
    signs = (points >= 0x2000) & (points < 0x2C00) | (points >= 0x3000) & (points < 0x3005)
    return ascii_letter | (points >= 0xC0) & (points != 0xD7) & (points != 0xF7) & ~signs


def host_of(address: Column) -> Column:
    """The host of an address in lower case; a bare host name is its own host."""
    bare = F.regexp_replace(F.lower(address), r"^[a-z][a-z0-9+.-]*://", "")
    return F.nullif(F.regexp_extract(bare, r"^([^/?#:]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """What stands behind the last dot of a host; null without a dot."""
    return F.nullif(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit(""))


def declared_of(label: Column) -> Column:
    """The first part of a declared language tag, in lower case."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(label)), r"^([a-z]{2,8})", 1), F.lit(""))


def languages_of(rows: DataFrame) -> dict[str, int]:
    """The languages that rows declare often enough, sorted, with their rows."""
    counts = rows.filter("_declared IS NOT NULL").groupBy("_declared").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    kept = counts.filter((F.col("n") >= LEAST_SHARE * total) | (F.col("n") >= LEAST_ROWS)).collect()
    return dict(sorted((r["_declared"], r["n"]) for r in kept))


def fit_letters(rows: DataFrame, languages: dict[str, int], train_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihoods, buckets by languages, from a sample of ``train_rows`` labelled rows or so.

    Rare languages are sampled more densely (``LEAST_TRAIN_ROWS``). The sample is
    picked by a hash of the row; partial counts come from the tasks and are added up
    by Spark, so a fixed number of numbers arrives here. The second array has, by
    language, mean and standard deviation of the log-likelihood of a run of its
    own text, with that run left out of the counts.
    """
    places = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(places), BUCKETS), np.int64)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = text.as_py() or ""
                counts[places[name]] += np.bincount(run_codes(own), minlength=BUCKETS)
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang), pa.array(bucket), pa.array(counts[lang, bucket])], ["lang", "bucket", "n"]
        )

    overall = train_rows / max(sum(languages.values()), 1)
    shares = {x: min(1.0, max(overall, LEAST_TRAIN_ROWS / max(n, 1))) for x, n in languages.items()}
    limits = F.create_map(*[F.lit(v) for x, share in shares.items() for v in (x, int(share * 1_000_000))])
    sample = rows.filter(F.col("_declared").isin(list(languages))).filter(
        F.pmod(F.col("_k1"), F.lit(1_000_000)) < limits[F.col("_declared")]
    )
    parts = sample.select("_declared", "_text").mapInArrow(run, "lang bigint, bucket bigint, n bigint")
    found = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros((BUCKETS, len(languages)))
    seen[found["bucket"].to_numpy(np.int64), found["lang"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    counts = seen + 0.5
    return np.log(counts / counts.sum(axis=0)).astype(np.float32), spread_of(seen)


def spread_of(seen: np.ndarray) -> np.ndarray:
    """Mean and standard deviation, by language, of the log-likelihood of each run without itself."""
    total = np.maximum(seen.sum(axis=0), 1)
    others = np.log((np.maximum(seen - 1, 0) + 0.5) / (total - 1 + 0.5 * len(seen)))
    weight = seen / total
    mean = (weight * others).sum(axis=0)
    return np.stack([mean, np.maximum(np.sqrt((weight * (others - mean) ** 2).sum(axis=0)), LEAST_SPREAD)])


def text_likelihoods(rows: DataFrame, model: np.ndarray, spread: np.ndarray) -> DataFrame:
    """``letters``, ``scores`` (a scaled log-likelihood per language) and ``fit`` of each whole text.

    ``fit`` is how many standard errors the text is above what its nearest language
    has on its own text, below zero if it is less likely.
    """
    shared = rows.sparkSession.sparkContext.broadcast((model, spread))

    def compute(texts: list[str]) -> list:
        table, (mean, deviation) = shared.value
        scores = np.zeros((len(texts), table.shape[1]))
        counts = np.zeros(len(texts), np.int64)
        fits = np.zeros(len(texts))
        for i, text in enumerate(texts):
            codes = run_codes(text)
            if len(codes):
                counts[i] = len(codes)
                often = np.bincount(codes, minlength=BUCKETS)
                used = np.flatnonzero(often) if len(codes) < BUCKETS else slice(None)
                total = often[used] @ table[used]
                scores[i] = total * min(1.0, FULL_RUNS / len(codes))
                fits[i] = ((total / len(codes) - mean) / deviation).max() * min(len(codes), FULL_RUNS) ** 0.5
        return [counts, list(scores), fits]

    keep = ["doc_id", "_k1", "_k2", "_declared", "_host"]
    return map_texts(rows, keep, "_text", compute, "letters bigint, scores array<double>, fit double")


def evidence(value: Column, languages: list[str], right: float) -> Column:
    """Log-probabilities of seeing ``value`` under each language; nothing if it is no language."""
    n = len(languages)
    wrong = (1 - right) / max(n - 1, 1)
    known = value.isin(languages) if languages else F.lit(False)
    each = [F.when(known, F.when(value == name, np.log(right)).otherwise(np.log(wrong))).otherwise(0.0) for name in languages]
    return F.array(*[F.coalesce(e, F.lit(0.0)).cast("double") for e in each])


def added(*arrays: Column) -> Column:
    total = arrays[0]
    for other in arrays[1:]:
        total = F.zip_with(total, other, lambda a, b: a + b)
    return total


def certainty(logs: Column) -> Column:
    """The probability of the likeliest entry, from log-probabilities up to a constant."""
    top = F.array_max(logs)
    return 1 / F.aggregate(F.transform(logs, lambda x: F.exp(x - top)), F.lit(0.0), lambda a, b: a + b)


def best(values: Column) -> Column:
    """Place of the largest one, from 1; the first at ties."""
    return F.array_position(values, F.array_max(values)).cast("int")


def host_priors(scored: DataFrame, n: int) -> DataFrame:
    """``_host`` and ``prior``, probabilities of the languages on it, smoothed by the levels above.

    Counts of the languages that the texts alone show, per host, per address suffix
    and in all: a host leans on its suffix, a suffix on the whole.
    """
    shown = scored.filter("letters > 0").withColumn("lang", best(F.col("scores")))
    sums = [F.count(F.when(F.col("lang") == i + 1, 1)).alias(f"c{i}") for i in range(n)]
    hosts = shown.filter("_host IS NOT NULL").groupBy("_host").agg(*sums)
    hosts = stage(hosts.withColumn("_suffix", suffix_of(F.col("_host"))), "lang-hosts")
    total = shown.agg(F.array(*sums).alias("all"))  # one row
    counts = F.array(*[F.col(f"c{i}") for i in range(n)])
    up = [F.sum(f"c{i}").alias(f"c{i}") for i in range(n)]
    suffixes = hosts.groupBy("_suffix").agg(*up).select(F.col("_suffix").alias("_s"), counts.alias("of_suffix"))

    def number(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)

    def smoothed(own: Column, above: Column, weight: float) -> Column:
        return F.zip_with(own, above, lambda c, p: (c + weight * p) / (number(own) + weight))

    even = F.array_repeat(F.lit(1.0 / max(n, 1)), n)
    joined = (
        hosts.select("_host", "_suffix", counts.alias("of_host"))
        .join(suffixes, F.col("_suffix").eqNullSafe(F.col("_s")))
        .crossJoin(F.broadcast(total.select(smoothed(F.col("all"), even, 1.0).alias("whole"))))
    )
    # Hosts without a suffix have no level between them and the whole.
    middle = F.when(F.col("_suffix").isNull(), F.col("whole")).otherwise(
        smoothed(F.col("of_suffix"), F.col("whole"), SUFFIX_WEIGHT)
    )
    return stage(
        joined.select("_host", "of_host", middle.alias("middle")).select(
            "_host", smoothed(F.col("of_host"), F.col("middle"), HOST_WEIGHT).alias("prior")
        ),
        "lang-priors",
    )


def identify_languages(
    docs: DataFrame,
    text: str = "text",
    declared: Column | str = "lang",
    address: Column | str = "source",
    doc_id: str = "doc_id",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """Per input row doc_id, a row key, ``language``, ``posterior``, ``text_language``, ``kept``.

    The posterior adds up, in logs, the likelihood of the letters, of the declared
    language (markup or a column), of an address suffix that is a language's code, and
    the prior of the host (hierarchically smoothed counts). The languages are those
    that the rows declare; without any declared language nothing is known and all
    rows are rejected with null language. Declared values are cut to their first part
    (``en-US`` is ``en``); unknown and null ones say nothing, as does a null address.
    A text without letters (null and empty ones too) is rejected, whatever else is
    declared, and so is one whose letters fit none of the languages (``LEAST_FIT``):
    the posterior only weighs these against each other. Ties go to the first language in the alphabet; repeated rows are
    treated alike; an empty table gives no rows; other columns are not read.
    """
    picked = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("_text"),
        declared_of(F.col(declared) if isinstance(declared, str) else declared).alias("_declared"),
        host_of(F.col(address) if isinstance(address, str) else address).alias("_host"),
    )
    rows = picked.select("*", *row_key(F.col("doc_id"), F.col("_text")))
    found = languages_of(rows)
    languages = list(found)
    if not languages:
        none = F.lit(None).cast("string")
        return rows.select(
            "doc_id", "_k1", "_k2", none.alias("language"), F.lit(None).cast("double").alias("posterior"),
            none.alias("text_language"), F.lit(False).alias("kept"),
        )
    n = len(languages)
    model, spread = fit_letters(rows, found, train_rows)
    scored = stage(text_likelihoods(rows, model, spread), "lang-scores")
    priors = host_priors(scored, n)
    joined = scored.join(priors, "_host", "left")
    suffix = suffix_of(F.col("_host"))
    prior = F.coalesce(F.transform("prior", lambda p: F.log(p)), F.array_repeat(F.lit(0.0), n))
    fused = added(
        F.col("scores"),
        evidence(F.col("_declared"), languages, DECLARED_RIGHT),
        evidence(suffix, languages, SUFFIX_RIGHT),
        prior,
    )
    names = F.array(*[F.lit(x) for x in languages])
    judged = joined.withColumn("_fused", fused).withColumn("posterior", certainty(F.col("_fused")))
    return judged.select(
        "doc_id",
        "_k1",
        "_k2",
        F.element_at(names, best(F.col("_fused"))).alias("language"),
        "posterior",
        F.when(F.col("letters") > 0, F.element_at(names, best(F.col("scores")))).alias("text_language"),
        (
            (F.col("letters") > 0) & (F.col("posterior") >= LEAST_POSTERIOR) & (F.col("fit") >= LEAST_FIT)
        ).alias("kept"),
    )


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose language is identified; columns stay, whatever their names.

    Options and special cases are those of :func:`identify_languages`.
    """
    found = identify_languages(docs, **options).filter("kept").select("_k1", "_k2").distinct()
    text, doc_id = options.get("text", "text"), options.get("doc_id", "doc_id")
    rows = docs.select(whole_row(docs).alias("_row"), *row_key(F.col(doc_id), F.col(text)))
    return unpack(rows.join(found, ["_k1", "_k2"], "left_semi"), docs.columns)
