"""Text columns with the same results as Python's string methods.

Only built-in expressions: `strip` is a byte-wise trim over a fixed character
set, the rest are regular expressions that touch every character a bounded
number of times (a look-behind stops them from re-scanning long blank runs).
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftloom.functions.rows import bind

# fixed values: the characters Python treats as whitespace, and as line ends
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


# the same sets inside Java patterns; (?U) makes \\s cover all of Unicode
WS = r"\s\x1c-\x1f"
_LB = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"
_WS_NO_LF = rf"[{WS}&&[^\n]]"
_WS_IN_LINE = rf"[{WS}&&[^{_LB}]]"
_LINE_END = rf"\r\n|[{_LB}]"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def normalize_newlines(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def remove_trailing_spaces(c: Column) -> Column:
    gap = _WS_NO_LF
    return F.regexp_replace(c, rf"(?U){gap}(?<!{gap}{gap}){gap}*+(?=\n|\z)", "")


def collapse_blank_lines(c: Column, maximum: int = 2) -> Column:
    """At most so many line feeds in a row; most texts have no more and pass as they are."""
    return bind(c, lambda text: F.when(
        F.contains(text, F.lit("\n" * (maximum + 1))),
        F.regexp_replace(text, rf"\n{{{maximum + 1},}}", "\n" * maximum)).otherwise(text))


def remove_invalid_utf(c: Column) -> Column:
    """Drop undecodable bytes; replacement characters of the text itself stay."""
    own, aside = F.lit("\ufffd"), F.lit("\ufdd0")
    marked = F.make_valid_utf8(F.replace(c, own, aside))
    repaired = F.replace(F.replace(marked, own, F.lit("")), aside, own)
    return F.when(F.is_valid_utf8(c), c).otherwise(repaired)


def clean_text(c: Column) -> Column:
    """Repair encoding, unify line ends, drop trailing and surplus blanks; null is ''."""
    text = remove_invalid_utf(F.coalesce(c, F.lit("")))
    return strip(collapse_blank_lines(remove_trailing_spaces(normalize_newlines(text))))


def lower_strip(c: Column) -> Column:
    return strip(F.lower(F.coalesce(c, F.lit(""))))


def _no_parts() -> Column:
    return F.array().cast("array<string>")


def _split_filled(c: Column, separator: str) -> Column:
    """Parts of a text between separators; an empty text has none."""
    return F.when(c == "", _no_parts()).otherwise(F.split(c, separator, -1))


def split_lines(c: Column) -> Column:
    """Lines of the text; a final line end opens no further line."""
    body = F.regexp_replace(c, rf"(?:{_LINE_END})\z", "")
    return F.when(c == "", _no_parts()).otherwise(F.split(body, _LINE_END, -1))


def with_line_counts(c: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use(lines, chars)`` with the number of ``split_lines`` and of their characters, which are
    counted without making the lines."""
    def counted(text):
        ended = F.substring(text, -1, 1).isin(*LINE_ENDS)
        return bind(F.length(F.translate(text, LINE_ENDS, "")), lambda chars: use(
            F.when(text == "", 0).otherwise(F.length(text) - chars + F.when(ended, 0).otherwise(1)), chars))
    return bind(F.replace(c, F.lit("\r\n"), F.lit("\n")), counted)


def stripped_lines(c: Column) -> Column:
    """Non-blank lines without surrounding whitespace.

    Every whitespace run that holds a line end separates two such lines, so one
    split of the stripped text finds them all without a per-line expression.
    """
    gap = rf"(?U)[{WS}](?<![{WS}][{WS}])(?:(?<=[{_LB}])|{_WS_IN_LINE}*+[{_LB}])[{WS}]*+"
    return _split_filled(strip(c), gap)


def words(c: Column) -> Column:
    """Whitespace-separated words in order."""
    return _split_filled(strip(c), rf"(?U)[{WS}]+")


def lookup(c: Column, table: dict) -> Column:
    """Value for ``c`` in a small fixed table, null when absent."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), c)


def clean_sample(df):
    """Clean the three text fields and fold language and license names."""
    return df.withColumns({
        **{name: clean_text(F.col(name)) for name in ("instruction", "input", "output")},
        "language": lower_strip(F.col("language")),
        "license": lower_strip(F.col("license")),
    })
