"""Conversations as training examples: one per assistant turn, with its prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.functions.text import running

#: The control strings of the template.
TURN, BODY, END, STOP = "<s>", "[INST]", "[/INST]", "</s>"


def escape(text: Column) -> Column:
    """Put one backslash more behind the bracket of anything that looks like a control string.

    Afterwards no control string is left; :func:`unescape` takes the backslash away.
    """
    angle = F.regexp_replace(text, r"<(\\*)(/?s>)", r"<$1\\$2")
    return F.regexp_replace(angle, r"\[(\\*)(/?INST\])", r"[$1\\$2")


def unescape(text: Column) -> Column:
    angle = F.regexp_replace(text, r"<(\\*)\\(/?s>)", r"<$1$2")
    return F.regexp_replace(angle, r"\[(\\*)\\(/?INST\])", r"[$1$2")


def format_conversations(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv`` and ``segments``, its formatted text in order.

    A segment has ``text``, ready to be joined with what stands before and behind,
    ``trainable``, and ``turn_no`` from 0. Only the bodies of ``trained_role`` are
    trainable. Every prefix of the segments that ends with a trainable one is a
    training example, which :func:`prefix_examples` writes out.

    Turns are ordered by turn, then role, then text, nulls first, so ties have a
    fixed order; repeated rows are repeated turns. Null roles and texts are empty,
    rows without conversation id form one conversation, an empty table gives no
    rows, and other columns are not read. A conversation is put together in one
    task, as its text is one cell of the result.
    """
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    ordered = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t"))

    def parts(t: Column, i: Column) -> Column:
        def part(content: Column, trainable: Column) -> Column:
            return F.struct(
                content.alias("text"), trainable.alias("trainable"), i.cast("long").alias("turn_no")
            )

        return F.array(
            part(F.concat(F.lit(TURN), escape(t["role"]), F.lit(BODY)), F.lit(False)),
            part(escape(t["text"]), t["role"] == trained_role),
            part(F.lit(END + STOP), F.lit(False)),
        )

    segments = F.flatten(F.transform("t", parts))
    return ordered.select(F.col("conv").alias(conv), segments.alias("segments"))


def replies(segments: Column) -> Column:
    """One entry per trainable segment: how many segments stand before it, and its text."""
    marked = F.transform(
        segments,
        lambda s, i: F.struct(
            i.alias("context_segments"), s["text"].alias("reply"), s["trainable"].alias("trainable")
        ),
    )
    return F.filter(marked, lambda s: s["trainable"])


def prefix_examples(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Explode every trainable segment into its own example, with all that stands before it.

    Columns: ``conv``, ``example_no`` from 0, ``context_segments`` (how many of the
    conversation's segments are the context), ``context``, these as text, and
    ``reply``, which the loss covers alone. A conversation's beginning is repeated
    once per later reply, as in a file of training examples; the tasks make one
    example after the other and hold the context of one. A conversation without
    trainable turn has no example.
    """
    examples = formatted.select(
        F.col(conv).alias(conv),
        "segments",
        F.posexplode(replies(F.col("segments"))).alias("example_no", "_e"),
    )
    before = F.slice("segments", F.lit(1), F.col("_e.context_segments"))
    context = F.array_join(F.transform(before, lambda s: s["text"]), "")
    return examples.select(conv, "example_no", "_e.context_segments", context.alias("context"), "_e.reply")


def render_examples(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What a file of examples holds: ``conv``, ``example_no``, ``context``, ``reply``."""
    return prefix_examples(formatted, conv).select(conv, "example_no", "context", "reply")


def read_turns(formatted_text: Column) -> Column:
    """Role and text of each turn, read back from a formatted conversation."""
    whole = F.filter(F.split(formatted_text, STOP), lambda t: t != "")

    def turn(t: Column) -> Column:
        body = F.instr(t, BODY)
        return F.struct(
            unescape(F.substring(t, F.lit(len(TURN) + 1), body - len(TURN) - 1)).alias("role"),
            unescape(
                F.substring(t, body + len(BODY), F.length(t) - body - len(BODY) + 1 - len(END))
            ).alias("text"),
        )

    return F.transform(whole, turn)


def reply_starts(formatted_text: Column) -> Column:
    """Of each turn of a formatted conversation, how many code points stand before its text."""
    whole = F.filter(F.split(formatted_text, STOP), lambda t: t != "")
    ends = running(F.transform(whole, lambda t: F.length(t) + len(STOP)))
    return F.zip_with(whole, ends, lambda t, end: end - len(STOP) - F.length(t) + F.instr(t, BODY) + len(BODY) - 1)


def examples_fit(examples: Column, whole: Column, turns: Column, trained_role: str = "assistant") -> Column:
    """Whether ``examples`` are those of the formatted text ``whole`` with its ``turns``.

    That is one per trained turn, in order, with the three segments of every turn
    before it and the opening of its own as context: as many segments, as many code
    points and, by a hash, the same text as stands before the reply in ``whole``.
    """
    placed = F.zip_with(turns, reply_starts(whole), lambda t, start: F.struct(t["role"].alias("role"), t["text"].alias("reply"), start.alias("start")))
    asked = F.filter(
        F.transform(placed, lambda t, i: F.struct((3 * i + 1).alias("context_segments"), t.alias("t"))),
        lambda x: x["t"]["role"] == trained_role,
    )
    made = F.transform(
        examples,
        lambda e: F.struct(
            e["example_no"].alias("no"),
            e["context_segments"].alias("context_segments"),
            e["context_chars"].alias("context_chars"),
            e["context_hash"].alias("context_hash"),
            unescape(e["reply"]).alias("reply"),
        ),
    )
    numbered = F.transform(
        asked,
        lambda x, i: F.struct(
            i.alias("no"),
            x["context_segments"].alias("context_segments"),
            x["t"]["start"].alias("context_chars"),
            F.xxhash64(F.substring(whole, F.lit(1), x["t"]["start"])).alias("context_hash"),
            x["t"]["reply"].alias("reply"),
        ),
    )
    return made == numbered


def conversation_digests(turns: DataFrame) -> DataFrame:
    """What the formatted conversations and their examples say, as counts and digests.

    ``turns_sha256`` is read back from the joined text, the loss columns from the
    exploded examples of :func:`prefix_examples` in their order. Every example is made
    with its whole context; length and hash of that go on to where the examples of a
    conversation meet. Every assistant turn that is read back must have its example,
    with exactly what stands before its reply as context; otherwise the query fails.
    Conversations without a reply have no loss.
    """
    formatted = format_conversations(turns)
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    read = formatted.select("conv_id", whole.alias("whole")).withColumn("turns", read_turns(F.col("whole")))
    context = [F.length("context").alias("context_chars"), F.xxhash64("context").alias("context_hash")]
    example = F.struct("example_no", "context_segments", "context_chars", "context_hash", "reply")
    examples = (
        prefix_examples(formatted)
        .select("conv_id", "example_no", "context_segments", *context, "reply")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(example)).alias("examples"))
        .withColumnRenamed("conv_id", "_conv")
    )
    joined = read.join(examples, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    none = F.array().cast("array<struct<example_no:int,context_segments:int,context_chars:int,context_hash:bigint,reply:string>>")
    told = joined.withColumn("examples", F.coalesce("examples", none))
    loss = F.array_join(F.transform("examples", lambda e: unescape(e["reply"])), "")
    wrong = F.raise_error(F.concat(F.lit("examples do not fit conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    checked = F.when(examples_fit(F.col("examples"), F.col("whole"), F.col("turns")), loss).otherwise(wrong.cast("string"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return told.withColumn("loss", checked).select(
        "conv_id",
        F.array_size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("whole").cast("long").alias("formatted_chars"),
    )
