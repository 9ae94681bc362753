"""Lexical token counts.

The counter is a plain ``Column -> Column`` function, so a caller with a real
tokenizer passes its own (a pandas UDF, say) wherever ``counter`` appears.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftloom.constants import MAX_TOKENS
from siftloom.schema import TEXT_FIELDS

_WORD = "[A-Za-z0-9_]+"
_BLANKS = " \t\n\x0b\x0c\r"
_BLANK_CLASS = r" \t\n\x0b\x0c\r"
TOKEN = rf"{_WORD}|[^A-Za-z0-9_{_BLANK_CLASS}]"


def count_tokens(c: Column) -> Column:
    """Word runs plus single other non-blank characters.

    Shrinking every word to one letter and dropping blanks leaves one character
    per token, which avoids building an array of all tokens.
    """
    short = F.regexp_replace(c, _WORD, "w")
    for blank in _BLANKS:
        short = F.replace(short, F.lit(blank), F.lit(""))
    return F.length(short).cast("bigint")


def sample_tokens(counter=count_tokens) -> Column:
    """Tokens of instruction, input and output together."""
    first, *rest = [counter(F.col(name)) for name in TEXT_FIELDS]
    for part in rest:
        first = first + part
    return first


def truncate(c: Column, max_tokens: int = MAX_TOKENS) -> Column:
    """Text of the first ``max_tokens`` tokens; each keeps the blanks before it."""
    tokens = F.regexp_extract_all(c, F.lit(rf"[{_BLANK_CLASS}]*(?:{TOKEN})"), F.lit(0))
    return F.array_join(F.slice(tokens, 1, max_tokens), "")


def within_limit(max_tokens: int = MAX_TOKENS, counter=count_tokens) -> Column:
    return sample_tokens(counter) <= max_tokens
