"""Text to values: flags, numbers, address parts, markup."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it.

    Inside conditions and lambdas a repeated expression is computed again each time.
    """
    return F.get(F.transform(F.array(value), use), 0)


def yes_no(condition: Column) -> Column:
    """``'Y'`` where true, ``'N'`` where false or unknown."""
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def money(text: Column) -> Column:
    """``'$1,234'`` → 1234; null if it is not a whole number."""
    return F.regexp_replace(text, "[$,]", "").try_cast("bigint")


def title_id(text: Column) -> Column:
    """The first ``tt…`` id in a link, or null."""
    return bind(F.regexp_extract(text, r"(tt\d+)", 1), non_empty)


def path_part(url: Column, position: int) -> Column:
    """Part of a ``/``-separated address; negative positions count from the end."""
    return F.split_part(url, F.lit("/"), F.lit(position))


def source_type(url: Column, search: str) -> Column:
    """What a page lists: the query of a search address, else the last folder."""
    return F.when(F.contains(url, F.lit(search)), path_part(url, -1)).otherwise(path_part(url, -2))


# Named references: those that end with a semicolon, by the first letter of their name,
# each as ``\x01name\x02characters``, and the few that are read without one.
_PAIR, _IS, _NEXT = "\x01", "\x02", "\x03"
_FIRST = ord("A")
NAMED_REFERENCES = [
    "".join(f"{_PAIR}{n[:-1]}{_IS}{c}" for n, c in html5.items() if n.endswith(";") and ord(n[0]) == code) + _PAIR
    for code in range(_FIRST, ord("z") + 1)
]
OPEN_REFERENCES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _character(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _named(name: Column) -> Column:
    """Characters of a name, null if there is none such: a search among names with its first letter."""
    lists = F.split(F.lit(_NEXT.join(NAMED_REFERENCES)), _NEXT)  # made once, as it is constant

    def search(names: Column) -> Column:
        def after(place: Column) -> Column:
            start = place + F.length(name) + 2
            return F.when(place > 0, F.substring_index(F.substr(names, start), _PAIR, 1))

        return bind(F.instr(names, F.concat(F.lit(_PAIR), name, F.lit(_IS))), after)

    return bind(F.get(lists, F.ascii(name) - _FIRST), search)


def _reference(part: Column) -> Column:
    """Text after ``&`` with the reference it starts with, if valid, resolved.

    A name is looked up with its semicolon first; failing that, the longest name that
    is valid without one and that the text begins with counts, as in ``&ampx``. Numbers
    need no semicolon.
    """
    hexa = non_empty(F.regexp_extract(part, "^#[xX]([0-9a-fA-F]{1,6})(?![0-9a-fA-F])", 1))
    deci = non_empty(F.regexp_extract(part, "^#([0-9]{1,7})(?![0-9])", 1))
    name = non_empty(F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]*);", 1))
    begun = non_empty(F.regexp_extract(part, f"^({'|'.join(OPEN_REFERENCES)})", 1))

    def numbered(code: Column) -> Column:
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(valid, _character(code))

    number = bind(F.coalesce(F.conv(hexa, 16, 10), deci).try_cast("bigint"), numbered)

    def without_name(own: Column) -> Column:
        rest = F.substr(part, F.length(own) + 1)
        return bind(_named(own), lambda c: F.concat(c, rest))

    closed = bind(name, lambda n: bind(_named(n), lambda c: F.concat(c, F.substr(part, F.length(n) + 2))))
    opened = bind(begun, without_name)
    numeric = bind(number, lambda c: F.concat(c, F.regexp_replace(part, "^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", "")))
    numeric = F.when(F.startswith(part, F.lit("#")), numeric)
    named = F.when(part.rlike("^[A-Za-z]"), F.coalesce(closed, opened))
    return F.coalesce(numeric, named, F.concat(F.lit("&"), part))


def _resolved(text: Column) -> Column:
    pieces = F.transform(F.split(text, "&"), lambda p, i: F.when(i > 0, _reference(p)).otherwise(p))
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def uncommented(html: Column) -> Column:
    """Markup without comments; one that is never closed reaches to the end."""
    return F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")


def markup_text(html: Column) -> Column:
    """Text of a markup fragment: tags removed, all character references resolved once."""
    return bind(F.regexp_replace(html, "<[^>]*>", ""), _resolved)


def element(html: Column, tag: str) -> Column:
    """Inner markup of the first ``tag`` element, ``''`` if there is none."""
    return F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)


def elements(html: Column, tag: str) -> Column:
    """Inner markup of every ``tag`` element, in page order."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<(?:{tag})\b[^>]*>(.*?)</(?:{tag})\s*>"), F.lit(1))


def running(values: Column) -> Column:
    """Running sums of an array of integers.

    An array that grows by one is copied each time, so the sums are made in blocks of
    about the root of the length, and no array grows longer than that.
    """
    zero = F.array().cast("array<int>")

    def sums(part: Column, start: Column) -> Column:
        def grown(made: Column, value: Column) -> Column:
            before = F.when(F.size(made) > 0, F.element_at(made, -1)).otherwise(start)
            return F.concat(made, F.array(before + value))

        return F.aggregate(part, zero, grown)

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, b: a + b)

    def of_values(own: Column) -> Column:
        def in_blocks(width: Column) -> Column:
            starts = F.sequence(F.lit(1), F.greatest(F.size(own), F.lit(1)), width)
            blocks = F.transform(starts, lambda at: F.slice(own, at, width))

            def joined(parts: Column) -> Column:
                def behind(before: Column) -> Column:
                    return F.transform(parts, lambda p, i: sums(p, F.coalesce(F.get(before, i - 1), F.lit(0))))

                return F.flatten(bind(sums(F.transform(parts, total), F.lit(0)), behind))

            return bind(blocks, joined)

        return bind(F.greatest(F.ceil(F.sqrt(F.size(own))).cast("int"), F.lit(1)), in_blocks)

    return bind(values, of_values)


_TABLE_TAG = r"(?i)(?=</?table\b)"


def _table_depth(pieces: Column, start: int) -> Column:
    """How many tables are open behind the tag that each piece begins with."""
    def step(piece: Column) -> Column:
        return F.when(piece.rlike(r"(?i)^<table\b"), 1).when(piece.rlike(r"(?i)^</table\b"), -1).otherwise(0)

    return F.transform(running(F.transform(pieces, step)), lambda d: d + start)


def first_table(html: Column, opening: str = r"(?i)<table\b[^>]*>") -> Column:
    """Inner markup of the first table whose tag matches ``opening``, null if there is none.

    It ends at its own end tag, whatever tables its cells hold, or else with the page.
    """

    def inner(after: Column) -> Column:
        def balanced(pieces: Column) -> Column:
            end = F.array_position(_table_depth(pieces, 1), F.lit(0)).cast("int")
            return F.array_join(F.when(end > 0, F.slice(pieces, 1, F.greatest(end - 1, F.lit(0)))).otherwise(pieces), "")

        def cut(first: Column) -> Column:
            return F.when(first.rlike(r"(?i)<table\b"), bind(F.split(after, _TABLE_TAG), balanced)).otherwise(first)

        return bind(F.get(F.split(after, r"(?i)</table\b", 2), 0), cut)

    return bind(F.get(F.split(html, opening, 2), 1), inner)


def outer_parts(html: Column, opening: str, ending: str) -> Column:
    """Inner markup of the elements ``opening`` that no table within ``html`` holds, in page order.

    An element ends at the next tag ``ending`` (with its own opening tags among them)
    outside such tables, so it needs no end tag. Tags are alternatives of a pattern.
    """
    edge = rf"(?i)(?=<(?:{ending})\b)"
    begins = rf"(?i)^<(?:{opening})\b"

    def stripped(parts: Column) -> Column:
        kept = F.filter(parts, lambda p: p.rlike(begins))
        return F.transform(kept, lambda p: F.regexp_replace(p, "^<[^>]*>", ""))

    def outside(pieces: Column) -> Column:
        def parts(depth: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(pieces) - 1)
            is_edge = F.filter(
                places,
                lambda i: (i == 0) | ((F.get(depth, i) == 0) & F.get(pieces, i).rlike(rf"(?i)^<(?:{ending})\b")),
            )

            def between(starts: Column) -> Column:
                return F.transform(
                    starts,
                    lambda at, k: F.array_join(
                        F.slice(pieces, at + 1, F.coalesce(F.get(starts, k + 1), F.size(pieces)) - at), ""
                    ),
                )

            return bind(is_edge, between)

        return bind(_table_depth(pieces, 0), parts)

    with_tables = bind(F.split(html, rf"(?i)(?=<(?:{ending}|/?table)\b)"), outside)
    parts = F.when(html.rlike(r"(?i)<table\b"), with_tables).otherwise(F.split(html, edge))
    return bind(parts, stripped)


_SECTIONS = "/?(?:tbody|thead|tfoot)"


def table_rows(table: Column) -> Column:
    """Inner markup of a table's own rows; a row may end without an end tag."""
    return outer_parts(table, "tr", f"/?tr|{_SECTIONS}")


def row_cells(row: Column, tag: str) -> Column:
    """Inner markup of a row's own ``tag`` cells; a cell may end without an end tag."""
    return outer_parts(row, tag, "/?(?:td|th)")


def currency_label(amount: Column) -> Column:
    """``$2.1B``, ``$15M``, ``$3K`` or ``$#,0``; null stays null."""
    billions = F.round(amount.cast("decimal(38,0)") / F.lit(10**9).cast("decimal(12,0)"), 1)
    whole = F.format_number(billions, 1)
    return (
        F.when(amount >= 10**9, F.concat(F.lit("$"), F.regexp_replace(whole, r"\.0$", ""), F.lit("B")))
        .when(amount >= 10**6, F.concat(F.lit("$"), F.format_number(F.round(amount / 10**6), 0), F.lit("M")))
        .when(amount >= 10**3, F.concat(F.lit("$"), F.format_number(F.round(amount / 10**3), 0), F.lit("K")))
        .when(amount < 0, F.concat(F.lit("-$"), F.format_number(-amount, 0)))
        .when(amount.isNotNull(), F.concat(F.lit("$"), F.format_number(amount, 0)))
    )
