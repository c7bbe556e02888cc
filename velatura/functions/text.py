"""Scalar text functions. Offsets are code points, from 0, with the end excluded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens of the default tokenizer: runs of letters, runs of digits, and any other character that is not ASCII white space.
TOKEN = r"\p{L}+|\p{N}+|[^\x09-\x0D\x20\p{L}\p{N}]"
#: What parts tokens never touch: characters that belong to words.
WORD_CHAR = r"[\p{L}\p{N}'’_-]"
SENTENCE_END = ".!?"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def digits(v: Column) -> Column:
    """Number of decimal digits."""
    return F.regexp_count(v, F.lit(r"\p{Nd}"))


def letters(v: Column) -> Column:
    """Number of letters."""
    return F.regexp_count(v, F.lit(r"\p{L}"))


def word_count(v: Column) -> Column:
    return F.regexp_count(v, F.lit(r"[^\x20\x09-\x0D]+"))


def running(sizes: Column) -> Column:
    """The sum of the numbers before each one.

    Adding to an array copies it, so this goes in blocks of about sqrt(n): sums within a block, and over the blocks before it.
    """
    n = F.size(sizes)
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def block(first: Column) -> Column:
        return let(F.slice(sizes, first + 1, width), lambda part: F.struct(part.alias("part"), total(part).alias("sum")))

    def within(part: Column, base: Column) -> Column:
        return F.aggregate(
            part, F.struct(base.alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"],
        )

    def joined(blocks: Column) -> Column:
        before = lambda i: F.aggregate(F.slice(blocks, F.lit(1), i), F.lit(0), lambda a, x: a + x["sum"])
        return F.flatten(F.transform(blocks, lambda x, i: within(x["part"], before(i))))

    return let(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), width), block), joined)


def _quoted(value: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(value, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def occurrences(text: Column, value: Column) -> Column:
    """Starts of the literal occurrences of ``value`` in ``text``, left to right, each search beginning after the one before.

    The gaps between occurrences are what a split by the quoted value leaves; their lengths add up to the starts.
    """
    size = F.length(value)

    def starts(gaps: Column) -> Column:
        lengths = F.transform(F.slice(gaps, F.lit(1), F.size(gaps) - 1), lambda g: F.length(g))
        # what was passed before each occurrence: the gaps up to it, and the occurrences before
        return let(lengths, lambda xs: F.transform(F.arrays_zip(xs.alias("g"), running(F.transform(xs, lambda x: x + size)).alias("r")), lambda z: z["g"] + z["r"]))

    found = let(F.call_function("split", text, _quoted(value), F.lit(-1)), starts)
    return F.when((size > 0) & text.contains(value), found).otherwise(F.array().cast("array<int>"))


def occurrences_overlapping(text: Column, value: Column) -> Column:
    """As ``occurrences``, but the next search begins one character after the last start.

    A split before every place where the value follows leaves pieces whose lengths add up to the starts; none is
    cut off at the very beginning.
    """

    def starts(pieces: Column) -> Column:
        inner = running(F.transform(pieces, lambda x: F.length(x)))
        return F.concat(F.when(text.startswith(value), F.array(F.lit(0))).otherwise(F.array().cast("array<int>")), F.slice(inner, F.lit(2), F.size(pieces)))

    found = let(F.call_function("split", text, F.concat(F.lit("(?="), _quoted(value), F.lit(")")), F.lit(-1)), starts)
    return F.when((F.length(value) > 0) & text.contains(value), found).otherwise(F.array().cast("array<int>"))


def is_word_boundary(text: Column, at: Column) -> Column:
    """Whether a cursor before character ``at`` does not lie between two word characters."""
    inside = F.substring(text, at, F.lit(1)).rlike(WORD_CHAR) & F.substring(text, at + 1, F.lit(1)).rlike(WORD_CHAR)
    return (at <= 0) | (at >= F.length(text)) | ~inside


def excerpt(text: Column, most: int = 200) -> Column:
    """The text with white space collapsed, cut to ``most`` characters with an ellipsis."""
    flat = F.regexp_replace(F.regexp_replace(text, r"[\x09-\x0D\x20]+", " "), r"^ | $", "")
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(F.left(flat, F.lit(most - 1)), F.lit("…")))


def escape_html(v: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n", " ")):
        v = F.replace(v, F.lit(a), F.lit(b))
    return v


def table_cell(v: Column) -> Column:
    return F.replace(F.replace(v, F.lit("|"), F.lit(r"\|")), F.lit("\n"), F.lit(" "))


def format_int(n: Column) -> Column:
    """With points between thousands."""
    return F.replace(F.format_number(n, 0), F.lit(","), F.lit("."))


def format_score(x: Column) -> Column:
    return F.format_string("%.4f (%.2f%%)", x, x * 100.0)
