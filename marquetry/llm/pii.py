"""Personal data: patterns, and words in the same documents that give them away.

A word reveals an entity (a mail address, IP, card or phone number) as far as
knowing the word says which entity is meant: pointwise mutual information, counted
over the corpus, against the information content of the entity itself. A word whose
mutual information reaches a share of that content is generalised; one that all
but identifies the entity is removed. Most addresses and numbers occur once, so each
entity also counts in its general form: the mail domain, the network, the issuer's
digits, the country code. What is counted is an estimate from some contexts, so its
lower confidence bound is what must reach the share, and the evidence of all contexts
together must outweigh the number of pairs among which it was looked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.functions.text import bind, running
from marquetry.sources.scratch import stage

from .common import row_key

#: The kinds in the order of the result, and their patterns. Repeats at the
#: end of a pattern are possessive, which finds the same and needs no stack; a run of
#: characters is tried from its start (or from the end of the match before) only.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a valid match of the kind.
HINTS = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){12}",
    "phone": r"\+[0-9]",
}
#: Kinds of spans that the co-occurrence adds, after the base kinds.
REMOVED, GENERALISED = "remove", "generalise"

#: Code points before and after an entity that tell its contexts apart.
REACH = 60
#: Standard errors that the share of a word's documents with the entity is taken lower.
CERTAINTY = 0.8
#: Bits of the word from which the first count takes a lower bound (:func:`at_least`).
MASK_BITS = 63
#: Shares of an entity's information content from which a word is generalised or removed.
GENERALISE_AT, REMOVE_AT = 0.75, 0.95
#: What is put in the place of a span.
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", REMOVED: "", GENERALISED: "[WORD]"}

SPACES = r"[\x20\x09-\x0D]"


def is_valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        def small(part: Column) -> Column:
            digits = F.regexp_replace(part, r"^0+(?=.)", "")
            return (F.length(digits) <= 3) & (digits.try_cast("int") <= 255)

        return F.forall(F.split(value, r"\."), small)
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def matches(text: Column, kind: str) -> Column:
    """All valid matches of a kind: start, end (code points, exclusive) and value, in order."""
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.slice(F.split(text, PATTERNS[kind]), 1, F.array_size(found))
    # The end of a match is the sum of all gaps and matches up to it.
    def spanned(own: Column) -> Column:
        ends = running(F.zip_with(between, own, lambda b, m: F.length(b) + F.length(m)))
        return F.zip_with(
            ends, own, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("value"))
        )

    spans = bind(found, spanned)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(HINTS[kind]), F.filter(spans, lambda s: is_valid(kind, s["value"]))).otherwise(none)


#: Code points of the blocks in which a text is looked up by position.
BLOCK = 1024


def general_form(kind: str, value: Column) -> Column:
    """The domain, network, issuer or country of an entity, in a form that no entity has."""
    if kind == "email":
        return F.regexp_extract(value, "@.*$", 0)
    if kind == "ip":
        return F.concat(F.regexp_extract(value, r"^(.*)\.[0-9]+$", 1), F.lit(".*"))
    if kind == "card":
        return F.concat(F.substring(F.regexp_replace(value, "[^0-9]", ""), 1, 6), F.lit("*"))
    return F.concat(F.regexp_extract(value, r"^\+[0-9]{1,3}", 0), F.lit("*"))


def contexts(text: Column, kind: str, spans: Column) -> Column:
    """Each span with its forms and ``REACH`` code points before and after it.

    One more on the outer side shows whether the outermost word is whole. Places are
    looked up in blocks of the text, as its start is far for most of them.
    """

    def piece(blocks: Column, start: Column, length: Column) -> Column:
        block = F.floor(start / BLOCK).cast("int")
        two = F.concat(F.coalesce(F.get(blocks, block), F.lit("")), F.coalesce(F.get(blocks, block + 1), F.lit("")))
        return F.substring(two, start % BLOCK + 1, length)

    def of_blocks(blocks: Column) -> Column:
        return F.transform(spans, lambda s: around(s, blocks))

    def around(s: Column, blocks: Column) -> Column:
        first = F.greatest(s["start"] - REACH - 1, F.lit(0))
        before = piece(blocks, first, s["start"] - first)
        after = piece(blocks, s["end"], F.lit(REACH + 1))
        value = F.lower(s["value"])
        return F.struct(
            F.transform(F.array(value, general_form(kind, value)), lambda v: F.concat(F.lit(f"{kind}:"), v)).alias("entities"),
            F.array(
                F.struct(first.alias("at"), F.when(first > 0, F.lit(1)).otherwise(0).alias("skip"), before.alias("part"), F.lit(True).alias("left")),
                F.struct(s["end"].alias("at"), F.lit(0).alias("skip"), after.alias("part"), F.lit(False).alias("left")),
            ).alias("sides"),
            F.xxhash64(before, after).alias("context"),
        )

    found = bind(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), of_blocks)
    none = "array<struct<entities:array<string>,sides:array<struct<at:int,skip:int,part:string,left:boolean>>,context:bigint>>"
    return F.when(F.size(spans) > 0, found).otherwise(F.array().cast(none))


def words_near(found: DataFrame) -> DataFrame:
    """One row per word of a context and form of its entity: row key, entity, context, term, start, end.

    A term is a word with a letter and without ``@``; it is compared in lower case
    without the punctuation around it.
    """
    entities = found.select("_k1", "_k2", F.explode("contexts").alias("c"))
    sides = entities.select("_k1", "_k2", "c.entities", "c.context", F.explode("c.sides").alias("s"))
    pieces = F.split(F.col("s.part"), SPACES)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(
        pieces,
        start,
        lambda done, p: F.struct(
            (done["at"] + F.length(p) + 1).alias("at"), F.array_append(done["starts"], done["at"]).alias("starts")
        ),
        lambda done: done["starts"],
    )
    placed = F.zip_with(pieces, starts, lambda p, s: F.struct(p.alias("word"), s.alias("offset")))
    words = sides.select("_k1", "_k2", "entities", "context", "s", F.explode(placed).alias("w"))
    # A word at the outer edge of the context may go on beyond it.
    cut_left = (F.col("s.left")) & (F.col("s.skip") == 1) & (F.col("w.offset") == 0)
    cut_right = ~F.col("s.left") & (F.col("w.offset") + F.length("w.word") > REACH)
    # What touches the entity is part of its own word.
    touches = F.when(F.col("s.left"), F.col("w.offset") + F.length("w.word") == F.length("s.part")).otherwise(
        F.col("w.offset") == 0
    )
    begin = F.col("s.at") + F.col("w.offset")
    return words.filter(is_term(F.col("w.word")) & ~cut_left & ~cut_right & ~touches).select(
        "_k1",
        "_k2",
        F.explode("entities").alias("entity"),
        "context",
        term(F.col("w.word")).alias("term"),
        begin.alias("start"),
        (begin + F.length("w.word")).alias("end"),
    )


def is_term(word: Column) -> Column:
    return word.rlike(r"\p{L}") & ~word.rlike("@")


def term(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))


def terms_of(text: Column) -> Column:
    """The different terms of a text."""
    own = F.filter(F.array_distinct(F.split(text, SPACES)), is_term)
    return F.array_distinct(F.transform(own, term))


def windows_of(found: DataFrame) -> DataFrame:
    """``entity`` and ``window`` of each document: its least context, one row per form it holds."""
    held = found.filter(F.size("contexts") > 0).dropDuplicates(["_k1", "_k2"])
    each = held.select("_k1", "_k2", F.explode("contexts").alias("c"))
    forms = each.select("_k1", "_k2", "c.context", F.explode("c.entities").alias("entity"))
    return forms.groupBy("_k1", "_k2", "entity").agg(F.min("context").alias("window"))


def sketched_terms(docs: DataFrame) -> DataFrame:
    """``terms`` of the documents that may hold an entity, and ``sketch``, their min-hash."""
    hinted = F.lit(False)
    for hint in HINTS.values():
        hinted = hinted | F.col("_text").rlike(hint)
    terms = docs.filter(hinted).select("_k1", "_k2", terms_of(F.col("_text")).alias("terms"))
    return terms.select("*", F.array_min(F.transform("terms", lambda t: F.xxhash64(t))).alias("sketch"))


def pairs_in_documents(
    windows: DataFrame, terms: DataFrame, total: DataFrame, with_term: DataFrame, with_entity: DataFrame
) -> DataFrame:
    """``entity``, ``term``, ``both`` (documents with the two) and ``apart``, over whole documents.

    ``apart`` is in how many different contexts of the entity, and different
    documents by a min-hash of their terms, the two meet at least: copies and near
    copies are one.
    Only pairs are left out that provably reach no verdict: those of a term or an
    entity that one document has, and those where the term has more than
    total^(1 - a) * holders^a documents, a the lowest share, so that even a term in all
    documents of the entity says too little.
    """
    bound = F.pow("total", F.lit(1 - GENERALISE_AT)) * F.pow("holders", F.lit(GENERALISE_AT))
    bounded = (
        windows.join(with_entity.filter("holders > 1"), "entity")
        .crossJoin(F.broadcast(total))  # one row
        .groupBy("_k1", "_k2")
        .agg(F.collect_list(F.struct("entity", "window", (bound * (1 + 1e-9)).alias("most"))).alias("entities"))
    )
    sketched = terms.join(bounded, ["_k1", "_k2"]).select("entities", "sketch", F.explode("terms").alias("term"))
    kept = sketched.join(with_term.filter("texts > 1"), "term").select(
        "term", "sketch", F.explode(F.filter("entities", lambda e: e["most"] >= F.col("texts"))).alias("e")
    )
    return kept.groupBy("e.entity", "term").agg(
        F.count(F.lit(1)).alias("both"),
        F.least(at_least(F.col("e.window")), at_least(F.col("sketch"))).alias("apart"),
    )


def at_least(hashed: Column) -> Column:
    """A lower bound of how many different values a group has, in a buffer of fixed size.

    The bits that the values set in one word, and two as soon as they are not all equal.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(hashed, F.lit(MASK_BITS)).cast("int"))
    return F.greatest(F.bit_count(F.bit_or(bit)), F.when(F.min(hashed) != F.max(hashed), 2).otherwise(1))


def counted_exactly(pairs: DataFrame, windows: DataFrame, terms: DataFrame, near: DataFrame) -> DataFrame:
    """``pairs`` with the exact numbers of different contexts and documents in the place of the bounds."""
    asked = pairs.select("entity", "term")
    said = terms.select("_k1", "_k2", "sketch", F.explode("terms").alias("term"))
    apart = (
        said.join(asked, "term")
        .join(windows, ["_k1", "_k2", "entity"])
        .groupBy("entity", "term")
        .agg(F.least(F.count_distinct("window"), F.count_distinct("sketch")).alias("apart"))
    )
    contexts = (
        near.join(asked, ["entity", "term"], "left_semi")
        .groupBy("entity", "term")
        .agg(F.count_distinct("context").alias("contexts"))
    )
    bare = pairs.drop("apart", "contexts")
    return bare.join(apart, ["entity", "term"], "left").join(contexts, ["entity", "term"], "left")


def revealing_terms(docs: DataFrame, near: DataFrame, found: DataFrame) -> DataFrame:
    """``entity``, ``term``, ``verdict`` of the words that disclose too much.

    Counted over all whole documents: those with the term and the entity, with the
    term, with the entity. Documents with both count as often as their contexts
    differ (of the pair in its documents or of the term near the entity, whichever
    are more), so copies prove nothing; a pair met in one context alone does not count.
    The share of the term's documents that have the entity is taken at its lower
    bound (Wilson's, by ``CERTAINTY``). The mutual information that this gives is
    held against the entity's content, and summed over the contexts against the
    number of pairs that could have been met: with as many bits, less than one pair
    of the corpus is expected to do so by chance.

    A verdict rises with the number of contexts. A first pass counts these from below
    in fixed space; where that gives the verdict that the number of documents, the
    most there can be, gives too, it stands. All other pairs are counted exactly.
    """
    words = docs.select(F.explode(terms_of(F.col("_text"))).alias("term"))
    # Every document gives a term once, and tasks combine before terms move.
    with_term = stage(words.groupBy("term").agg(F.count(F.lit(1)).alias("texts")), "pii-texts")
    held = found.select(F.explode(F.array_distinct(F.flatten("contexts.entities"))).alias("entity"))
    with_entity = stage(held.groupBy("entity").agg(F.count(F.lit(1)).alias("holders")), "pii-holders")
    total = found.agg(F.count(F.lit(1)).alias("total"))
    several = with_term.filter("texts > 1").agg(F.count(F.lit(1)).alias("terms"))
    several = several.crossJoin(F.broadcast(with_entity.filter("holders > 1").agg(F.count(F.lit(1)).alias("entities"))))
    windows, terms = windows_of(found), stage(sketched_terms(docs), "pii-words")
    close = (
        near.groupBy("entity", "term")
        .agg(at_least(F.col("context")).alias("contexts"), F.count_distinct("_k1", "_k2").alias("near"))
        .filter("contexts > 1")
    )
    together = pairs_in_documents(windows, terms, total, with_term, with_entity)
    pairs = (
        together.join(close, ["entity", "term"], "full")
        .filter("apart > 1 or contexts > 1")
        .join(with_term, "term")
        .join(with_entity, "entity")
        .crossJoin(F.broadcast(total.crossJoin(F.broadcast(several))))  # one row
        .withColumn("both", F.least(F.greatest("both", "near"), "texts", "holders"))
        .withColumns({"verdict": verdict(met()), "at_most": verdict(F.col("both"))})
        .filter(F.col("at_most").isNotNull())
    )
    pairs = stage(pairs, "pii-together")
    sure = F.col("verdict").eqNullSafe(F.col("at_most"))
    exact = counted_exactly(pairs.filter(~sure), windows, terms, near).withColumn("verdict", verdict(met()))
    names = ["entity", "term", "verdict"]
    return pairs.filter(sure).select(*names).unionByName(exact.filter(F.col("verdict").isNotNull()).select(*names))


def met() -> Column:
    """In how many different contexts a pair meets, no more than it has documents."""
    return F.least(F.greatest("apart", "contexts"), "both")


def verdict(met: Column) -> Column:
    """What a pair with its counts is judged if it is ``met`` in so many contexts, or null."""
    n = met + F.col("texts") - F.col("both")
    p, square = met / n, CERTAINTY * CERTAINTY
    lower = (p + square / (2 * n) - CERTAINTY * F.sqrt(p * (1 - p) / n + square / (4 * n * n))) / (1 + square / n)
    mutual = F.log2(lower * F.col("total") / F.col("holders"))
    content = F.log2(F.col("total") / F.col("holders"))
    share = F.when(content > 0, mutual / content)
    enough = met * mutual >= F.log2(F.col("terms") * F.col("entities"))
    return F.when(
        (met > 1) & (share >= GENERALISE_AT) & enough, F.when(share >= REMOVE_AT, REMOVED).otherwise(GENERALISED)
    )


def places_of(text: Column, verdicts: Column) -> Column:
    """All words of a text whose term is in the map ``verdicts``: verdict, start, end."""
    none = F.array().cast("array<struct<verdict:string,start:int,end:int>>")

    def hits(words: Column) -> Column:
        ends = running(F.transform(words, lambda w: F.length(w) + 1))

        def place(word: Column, end: Column) -> Column:
            verdict = F.when(is_term(word), F.try_element_at(verdicts, term(word)))
            return F.struct(verdict.alias("verdict"), (end - 1 - F.length(word)).alias("start"), (end - 1).alias("end"))

        return F.filter(F.zip_with(words, ends, place), lambda hit: hit["verdict"].isNotNull())

    return F.coalesce(bind(F.split(text, SPACES), hits), none)


def marked_words(docs: DataFrame, revealing: DataFrame) -> DataFrame:
    """``terms`` of each document that holds revealing words, wherever they stand."""
    verdicts = revealing.groupBy("term").agg(F.max("verdict").alias("verdict"))
    words = docs.select("_k1", "_k2", F.explode(terms_of(F.col("_text"))).alias("term"))
    hits = words.join(verdicts, "term").groupBy("_k1", "_k2")
    hits = hits.agg(F.map_from_entries(F.collect_set(F.struct("term", "verdict"))).alias("verdicts"))
    placed = docs.join(hits, ["_k1", "_k2"]).select("_k1", "_k2", places_of(F.col("_text"), F.col("verdicts")).alias("terms"))
    return placed.dropDuplicates(["_k1", "_k2"])


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Spans of personal data and of revealing words: one row per input row.

    Columns: doc_id, row key, an array per base kind of ``start``, ``end`` (code
    points, end exclusive) and ``value``, and ``terms``, an array of ``verdict``,
    ``start``, ``end``. Matches of a kind do not overlap; those of different kinds
    may. A word is a term if it shares documents with an entity or its general form,
    near or far, in different contexts, and is judged to reveal it
    (:func:`revealing_terms`); it is marked in all documents, also in those without
    the entity. Null texts are empty, repeated
    rows are treated alike, null ids are kept, an empty table gives no rows, and
    other columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("_text")).select(
        "doc_id",
        *row_key(F.col("doc_id"), F.col("_text")),
        "_text",
    )
    spanned = rows.select("*", *[matches(F.col("_text"), kind).alias(kind) for kind in KINDS])
    around = F.concat(*[contexts(F.col("_text"), kind, F.col(kind)) for kind in KINDS])
    found = stage(spanned.select("doc_id", "_k1", "_k2", *KINDS, around.alias("contexts")), "pii-base")
    near = words_near(found)
    revealing = stage(revealing_terms(rows, near, found), "pii-terms")
    spans = marked_words(rows, revealing)
    base = F.concat(*[as_spans(kind) for kind in KINDS])
    # A word that overlaps an entity is part of it.
    free = F.filter("terms", lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])))
    none = F.array().cast("array<struct<verdict:string,start:int,end:int>>")
    return found.join(spans, ["_k1", "_k2"], "left").select(
        "doc_id", "_k1", "_k2", *KINDS, F.coalesce(F.sort_array(free), none).alias("terms")
    )


def sanitise(text: Column, spans: Column) -> Column:
    """``text`` with ``MASKS`` in the place of its spans (arrays of kind, start, end).

    Where spans overlap, the one that begins first, then the longer one, is replaced
    and what is left of the others is cut away.
    """
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("stop"), s["kind"].alias("kind"))))
    masks = F.create_map(*[F.lit(x) for pair in MASKS.items() for x in pair])
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(done: Column, s: Column) -> Column:
        end = -s["stop"]
        gap = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        mask = F.when(s["start"] >= done["at"], masks[s["kind"]]).otherwise("")
        return F.struct(F.greatest(done["at"], end).alias("at"), F.concat(done["out"], gap, mask).alias("out"))

    return F.aggregate(
        ordered,
        begin,
        put,
        lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))),
    )


def as_spans(kind: str) -> Column:
    return F.transform(
        F.col(kind), lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def all_spans_column() -> Column:
    """Base spans by kind and start, then removed and generalised words."""
    terms = F.transform(
        "terms",
        lambda s: F.struct(s["verdict"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    by_kind = F.concat(
        F.filter(terms, lambda s: s["kind"] == REMOVED), F.filter(terms, lambda s: s["kind"] == GENERALISED)
    )
    return F.concat(*[as_spans(kind) for kind in KINDS], by_kind)


def sanitise_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and the sanitised text, one row per input row of ``docs``.

    Null texts become empty; see :func:`find_personal_data` for the other cases.
    """
    found = find_personal_data(docs, text, doc_id).select("_k1", "_k2", all_spans_column().alias("spans"))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text")).select(
        "*", *row_key(F.col("doc_id"), F.col("text"))
    )
    spans = found.dropDuplicates(["_k1", "_k2"])
    return rows.join(spans, ["_k1", "_k2"]).select("doc_id", sanitise(F.col("text"), F.col("spans")).alias("text"))


def span_digests(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    found = find_personal_data(docs)

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *[F.array_size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.array_size("terms").cast("long").alias("n_terms"),
        F.sha2(joined(F.concat(*[as_spans(kind) for kind in KINDS])), 256).alias("base_sha256"),
        joined(all_spans_column()).alias("spans"),
    )
