"""Programming-language names and detection as column expressions."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom import constants as C
from siftloom.functions.rows import literal, settled
from siftloom.functions.text import WS, lookup, lower_strip

_WORD_CHARS = r"\p{L}\p{N}_"


def java_pattern(pattern: str) -> str:
    """The evidence pattern with Python's word, space and line rules, in Java syntax.

    ``d`` and ``m`` make only a line feed end a line, ``i`` and ``u`` ignore case
    over all of Unicode, ``U`` widens the space class.
    """
    body = pattern.replace(r"[\w-]", f"[{_WORD_CHARS}-]").replace(r"\w", f"[{_WORD_CHARS}]")
    body = body.replace(r"\s", f"[{WS}]").replace(r"\b", f"(?![{_WORD_CHARS}])")
    return "(?imdU)" + re.sub(r"\{$", r"\\{", body)


def _needed_text(pattern: str) -> str:
    """A plain piece of the pattern; text without it cannot match."""
    if pattern.endswith("{"):
        return "{"
    pieces = re.split(r"\\[sw][+*]?|\[.*?\][+*]?|\\b|\.\*|\^", pattern)
    return max([re.sub(r"\\(.)", r"\1", piece) for piece in pieces], key=len).lower()


def filter_language_name(c: Column) -> Column:
    """Lower-cased, stripped, common spellings folded; other names pass through."""
    name = lower_strip(c)
    return F.coalesce(lookup(name, C.FILTER_LANGUAGE_ALIASES), name)


def normalize_language(c: Column) -> Column:
    """Canonical supported language, or 'unknown'."""
    name = lower_strip(c)
    return (F.when(name.isin(*C.SUPPORTED_LANGUAGES), name)
            .otherwise(F.coalesce(lookup(name, C.DETECTOR_LANGUAGE_ALIASES),
                                  F.lit(C.UNKNOWN))))


def from_extension(filename: Column) -> Column:
    """Language of the part after the last dot, null when there is none."""
    name = F.lower(filename)
    return F.when(F.contains(name, F.lit(".")),
                  lookup(F.substring_index(name, ".", -1), C.EXTENSION_LANGUAGES))


def from_shebang(code: Column) -> Column:
    first_line = F.lower(F.substring_index(code, "\n", 1))
    found = F.lit(None).cast("string")
    for fragments, language in reversed(C.SHEBANG_LANGUAGES):
        hit = reduce(Column.__or__, [F.contains(first_line, F.lit(x)) for x in fragments])
        found = F.when(hit, F.lit(language)).otherwise(found)
    return F.when(F.startswith(first_line, F.lit("#!")), found)


def folded(code: Column) -> Column:
    """Lower case with the few extra letters that match i, k and s ignoring case."""
    return F.lower(F.translate(code, "\u0130\u0131\u017f\u212a", "iisk"))


def keyword_scores(code: str, lowered: str, searchable: str) -> dict[str, str]:
    """SQL expression of the evidence score per language, over the named columns.

    Every keyword and pattern found adds its fixed weight. A pattern is only tried
    on text that holds a plain piece of it.
    """
    def found(condition, weight):
        return f"int({condition}) * {weight}"

    def contains(column, text):
        return f"contains({column}, {literal(text)})"

    return {
        language: " + ".join([
            *[found(contains(lowered, k), C.KEYWORD_WEIGHT) for k in keywords],
            *[found(f"({contains(searchable, _needed_text(p))} AND "
                    f"{code} RLIKE {literal(java_pattern(p))})", C.PATTERN_WEIGHT)
              for p in patterns],
        ])
        for language, keywords, patterns in C.LANGUAGE_EVIDENCE
    }


def from_keywords(code: str, lowered: str, searchable: str) -> Column:
    """Best-scoring language, the earlier listed on a tie; null without evidence.

    Takes the names of the code column, its lower-cased and its ``folded`` form.
    Score and list order make one number per language, so a single ``greatest``
    finds the winner; the extra entry wins when every score is zero.
    """
    scores = keyword_scores(code, lowered, searchable)
    size = len(scores)
    ranked = ", ".join(f"({score}) * {size + 1} + {size - 1 - rank}"
                       for rank, score in enumerate(scores.values()))
    names = ", ".join([literal(name) for name in reversed(scores)] + ["NULL"])
    return F.expr(f"get(array({names}), greatest({size}, {ranked}) % {size + 1})")


def with_language(df: DataFrame, code: str, into: str = "language",
                  filename: Column = None, hint: Column = None) -> DataFrame:
    """Add the detected language: shebang, file name, keywords, hint, else 'unknown'.

    Works on a frame because the lower-cased code is read by a hundred keyword
    tests: as a column of its own it is computed once per row.
    """
    text = F.col(code)
    tried = [from_shebang(text)]
    if filename is not None:
        tried.append(from_extension(filename))
    tried.append(F.when(F.length(text) > C.KEYWORD_MIN_CHARS,
                        from_keywords(code, "_lowered", "_folded")))
    if hint is not None:
        name = lower_strip(hint)
        tried.append(F.when(name.isin(*C.SUPPORTED_LANGUAGES), name))
    found = (df.withColumns({"_lowered": F.lower(text), "_folded": folded(text)})
             .withColumn(into, F.coalesce(*tried, F.lit(C.UNKNOWN)))
             .drop("_lowered", "_folded"))
    return settled(found, into)
