"""The operators over their whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, infill, language, lines, lm, mixing, near_dups, pii, quality, search, tokens, toxicity
from .common import read_table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


HAS_WORD = r"regexp_matches(line, '[^\x20\x09-\x0D]')"


@query(
    f"""
    WITH rows AS (
        SELECT doc_id, source, text, row_number() OVER () AS r, string_split(text, chr(10)) AS all_lines
        FROM documents
    ), lines AS (
        SELECT r, doc_id, source, pos, all_lines[pos] AS line
        FROM rows, unnest(range(1, len(all_lines) + 1)) AS x(pos)
    ), spread AS (
        SELECT line, min({{'id': doc_id, 'at': pos}}) AS first
        FROM lines WHERE {HAS_WORD} GROUP BY line HAVING count(DISTINCT source) >= 10
    ), marked AS (
        SELECT l.*, {HAS_WORD.replace('line', 'l.line')} AS full_line,
            s.line IS NOT NULL AND NOT ({{'id': l.doc_id, 'at': l.pos}} = s.first) AS gone
        FROM lines l LEFT JOIN spread s ON l.line = s.line
    )
    SELECT any_value(doc_id) AS doc_id,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
        count(*) FILTER (full_line)::BIGINT AS n_lines,
        count(*) FILTER (gone)::BIGINT AS n_removed
    FROM marked GROUP BY r
    """
)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.strip_boilerplate(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_removed")


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify_languages(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "language", "posterior", "text_language", "kept")


@query()
def llm_page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language ID over web pages, with the language of the markup and real addresses."""
    pages = read_table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.regexp_extract("html", r"<html[^>]*\blang=[\"']?([A-Za-z-]+)", 1).alias("markup"),
        F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ").alias("body"),
    )
    found = language.identify_languages(
        pages, text="body", declared="markup", address="url", doc_id="page_id"
    )
    return found.select(F.col("doc_id").alias("page_id"), "language", "posterior", "text_language", "kept")


@query()
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(read_table(spark, sf_dir, "documents"))


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition_rules(read_table(spark, sf_dir, "documents"))


@query(
    """
    WITH sizes AS (
        SELECT source, coalesce(sum(length(text)), 0)::BIGINT AS chars,
            CASE WHEN coalesce(sum(length(text)), 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weight
        FROM documents GROUP BY source
    ), rates AS (
        SELECT source, CASE WHEN weight > 0
            THEN weight * 1.0::DOUBLE * (SELECT sum(chars) FROM sizes)::DOUBLE
                / (SELECT sum(weight) FROM sizes) / chars::DOUBLE ELSE 0.0::DOUBLE END AS rate
        FROM sizes
    ), split AS (
        SELECT source, greatest(ceil(rate / 700.0), 1)::BIGINT AS parts, rate / greatest(ceil(rate / 700.0), 1) AS rate
        FROM rates
    ), terms AS (
        WITH RECURSIVE t AS (
            SELECT source, rate, 0 AS k, exp(-rate) AS term, exp(-rate) AS total FROM split
            UNION ALL
            SELECT source, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1)
            FROM t WHERE k < ceil(rate + 12 * sqrt(rate) + 20)
        )
        SELECT * FROM t
    ), rows AS (
        SELECT row_number() OVER () AS r, doc_id, source, text FROM documents
    ), draws AS (
        SELECT d.r, d.doc_id, d.source, d.text,
            ('0x' || substr(md5(CASE WHEN part = 1 THEN concat_ws('|', '0', coalesce(doc_id::VARCHAR, ''))
                ELSE concat_ws('|', '0', coalesce(doc_id::VARCHAR, ''), 'part' || part) END), 1, 13))::BIGINT
                / 4503599627370496.0::DOUBLE AS u
        FROM rows d JOIN split s ON s.source IS NOT DISTINCT FROM d.source, unnest(range(1, s.parts + 1)) AS x(part)
    ), drawn AS (
        SELECT d.r, d.doc_id, d.source, d.text,
            (SELECT count(*) FROM terms t
             WHERE t.source IS NOT DISTINCT FROM d.source AND t.total <= d.u) AS n
        FROM draws d
    ), counted AS (
        SELECT r, any_value(doc_id) AS doc_id, any_value(source) AS source, any_value(text) AS text, sum(n)::BIGINT AS n
        FROM drawn GROUP BY r
    )
    SELECT doc_id, source, text, copy, md5(concat_ws('|', 'order0', coalesce(doc_id::VARCHAR, ''), copy)) AS order_key
    FROM counted, unnest(range(1, n + 1)) AS x(copy)
    """
)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(read_table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "row.source", "row.text", "copy", "order_key")


@query()
def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(read_table(spark, sf_dir, "documents"))


@query()
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_matches(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), short_texts=True
    )
    return found.select("doc_id", "item_id", "similarity", "start", "n_windows")


@query()
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query(
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), escaped AS (
        SELECT *,
            regexp_replace(regexp_replace(text, '<(\\*)(/?s>)', '<\1\\\2', 'g'), '\[(\\*)(/?INST\])', '[\1\\\2', 'g') AS e_text,
            regexp_replace(regexp_replace(role, '<(\\*)(/?s>)', '<\1\\\2', 'g'), '\[(\\*)(/?INST\])', '[\1\\\2', 'g') AS e_role
        FROM turns
    )
    SELECT conv_id, count(*)::BIGINT AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
            AS loss_sha256,
        sum(length(e_role) + length(e_text) + 20)::BIGINT AS formatted_chars
    FROM escaped GROUP BY conv_id
    """
)
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(turns.unionByName(own))


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokens.read_ranks(VOCABULARY)
    return tokens.count_tokens(read_table(spark, sf_dir, "documents"), pieces)


LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = f"regexp_extract_all({LOWER.format('text')}, '{search.TERM}')"


@query(
    f"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, {TERMS} AS terms FROM documents
    ), corpus AS (
        SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs
    ), asked AS (
        SELECT q, item_id, term, count(*) AS repeats
        FROM (SELECT row_number() OVER () AS q, item_id, unnest({TERMS}) AS term FROM benchmark)
        GROUP BY ALL
    ), held AS (
        SELECT r, doc_id, n, term, count(*) AS tf
        FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
        GROUP BY ALL
    ), weights AS (
        SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
        FROM held, corpus GROUP BY term, n_docs
    ), scored AS (
        SELECT q, item_id, r, doc_id,
            sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
        FROM asked JOIN weights USING (term) JOIN held USING (term), corpus
        GROUP BY q, item_id, r, doc_id
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
        FROM scored WHERE score > 0
    )
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
    """
)
def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query(
    """
    WITH hashed AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
            regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
        FROM documents
    ), cut AS (
        SELECT *, len(units)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS c1,
            ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS c2,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
                WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM hashed
    ), parts AS (
        SELECT *, array_to_string(units[1:least(c1, c2)], '') AS prefix,
            array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
            array_to_string(units[greatest(c1, c2) + 1:], '') AS suffix
        FROM cut
    )
    SELECT doc_id, n, form,
        CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parts
    """
)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digests(read_table(spark, sf_dir, "documents"))


@query()
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
