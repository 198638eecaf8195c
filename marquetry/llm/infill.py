"""Fill-in-the-middle: texts cut at two ranks of their units and put in another order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import CHUNK_CHARS

#: The control strings before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Links of a lane that one link of the lane above spans.
FAN = 16

#: Code points of a text that are cut into units at a time.
PIECE = 1_000_000


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit: a longest run of ASCII letters, or any other code point."""
    parts, inside = [], False
    for start in range(0, len(text), PIECE):
        codes = np.frombuffer(text[start : start + PIECE].encode("utf-32-le"), np.uint32)
        lower = codes | 32
        letter = (lower >= 97) & (lower <= 122)
        begins = np.ones(len(codes), bool)
        begins[1:] = ~(letter[1:] & letter[:-1])
        if inside and letter[0]:
            begins[0] = False
        at = np.flatnonzero(begins)
        head = int(at[0]) if len(at) else len(codes)
        if head:
            parts[-1][-1] += head
        parts.append(np.diff(np.append(at, len(codes))).astype(np.int32))
        if not len(at):
            parts.pop()
        inside = bool(letter[-1])
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


class Lanes:
    """An indexable skip list over the units of a text.

    The lowest lane has a link per unit; a link of an express lane spans ``FAN``
    links of the lane below. Every link carries its width in units and in code
    points, so a rank is found from the top lane down, by adding widths as long as
    they do not pass it: about ``FAN`` links per lane.
    """

    def __init__(self, widths: np.ndarray) -> None:
        self.lanes = [(np.ones(len(widths), np.int64), widths)]
        while len(self.lanes[-1][0]) > FAN:
            units, chars = self.lanes[-1]
            at = np.arange(0, len(units), FAN)
            self.lanes.append((np.add.reduceat(units, at), np.add.reduceat(chars, at, dtype=np.int64)))

    def code_points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        link = seen = chars = 0
        for units_of, chars_of in reversed(self.lanes):
            while link < len(units_of) and seen + int(units_of[link]) <= rank:
                seen += int(units_of[link])
                chars += int(chars_of[link])
                link += 1
            link *= FAN
        return chars


def rearranged(doc_id: str, text: str, plain_from: int, spm_below: int) -> tuple:
    """n, form, code points of prefix and middle, and the output of one text."""
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    lanes = Lanes(unit_widths(text))
    n = len(lanes.lanes[0][0])
    if not text or h3 % 100 >= plain_from or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = (lanes.code_points_before(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < spm_below:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, first, second - first, output


def fill_in_middle(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    plain_from: int = 90,
    spm_below: int = 20,
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of each whole text.

    The cuts are two ranks among the units, hashed from the id; they are found in
    code points by the widths in an indexable skip list (:class:`Lanes`). Form psm
    is prefix, suffix, middle; spm, for hashes below ``spm_below`` of 100, suffix
    first; plain, for hashes from ``plain_from`` of 100 on, the text as it is, also
    if it is empty or holds a control string, with null for the widths.

    One row per input row, each made on its own: a null text counts as empty, a null
    id as an empty one, rows with an equal id share the hashes, repeated rows
    repeat. A very long text is cut in pieces and handled alone. An empty table
    gives no rows; no other column is read, so extra names do no harm.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    fields = StructType.fromDDL(schema).names
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, made, size = 0, [], 0
            for row, (key, value) in enumerate(zip(batch.column(1), batch.column(2))):
                made.append(rearranged(key.as_py() or "", value.as_py() or "", plain_from, spm_below))
                size += len(made[-1][-1])
                if size >= CHUNK_CHARS or row == batch.num_rows - 1:
                    arrays = [pa.array(x, t) for x, t in zip(zip(*made), types)]
                    arrays[-1] = arrays[-1].cast(pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(made)), *arrays], names=fields)
                    start, made, size = row + 1, [], 0

    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_id).cast("string").alias("_key"), F.col(text).alias("_text"))
    return picked.mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The exact text, from an output and its form.

    The text of a cut output holds no control string, and none can arise where a
    text meets one, so each stands exactly where it was put.
    """
    mark = len(PREFIX)

    def between(start: Column, end: Column) -> Column:
        return F.substr(output, start, F.greatest(end - start, F.lit(0)))

    second = F.when(form == "psm", F.instr(output, SUFFIX)).otherwise(F.instr(output, PREFIX))
    third = F.instr(output, MIDDLE)
    head, tail = between(F.lit(mark + 1), second), between(second + mark, third)
    middle = F.substr(output, third + mark)
    return (
        F.when(form == "psm", F.concat(head, middle, tail))
        .when(form == "spm", F.concat(tail, middle, head))
        .otherwise(output)
    )


def infill_digests(docs: DataFrame) -> DataFrame:
    """The outputs of :func:`fill_in_middle` as digests, with that of the text read back from them."""
    made = fill_in_middle(docs)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
