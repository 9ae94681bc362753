"""Row filters and the ordered accept/reject decision."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom import constants as C
from siftloom.functions.language import filter_language_name
from siftloom.functions.licenses import normalize_license
from siftloom.functions.rows import bind
from siftloom.functions.text import stripped_lines, with_line_counts


def is_empty(output: Column) -> Column:
    return F.length(output) == 0


def has_binary_content(output: Column) -> Column:
    return F.contains(output, F.lit("\u0000"))


def is_clean(output: Column) -> Column:
    return ~is_empty(output) & ~has_binary_content(output)


def language_allowed(name: Column, allowed=C.SUPPORTED_LANGUAGES) -> Column:
    """Test on an already normalized name; null and '' fail."""
    return F.coalesce(name.isin(*allowed), F.lit(False))


def license_allowed(name: Column, allowed=C.ALLOWED_LICENSES) -> Column:
    return F.coalesce(name.isin(*allowed), F.lit(False))


def has_autogenerated_notice(code: Column) -> Column:
    return bind(F.lower(code), lambda text: reduce(
        Column.__or__, [F.contains(text, F.lit(phrase)) for phrase in C.AUTOGENERATED_PHRASES]))


def looks_minified(code: Column) -> Column:
    """Few but long lines, or a mean line length above the limit.

    There are at least as many lines as line feeds; most texts pass by these alone.
    """
    size = F.length(code)
    feeds = size - F.length(F.replace(code, F.lit("\n"), F.lit("")))
    suspect = (feeds <= C.MINIFIED_MAX_LINES) | (size - feeds > feeds * C.MINIFIED_MEAN_LINE)
    return suspect & with_line_counts(code, lambda lines, chars: (
        ((lines <= C.MINIFIED_MAX_LINES) & (size > C.MINIFIED_MIN_CHARS))
        | (chars > lines * C.MINIFIED_MEAN_LINE)))


def has_excessive_repetition(code: Column) -> Column:
    return bind(stripped_lines(code), lambda lines: (
        (F.size(lines) >= C.REPETITION_MIN_LINES)
        & (F.size(F.array_distinct(lines)) * 100 < F.size(lines) * C.REPETITION_MIN_PERCENT)))


def has_suspicious_characters(code: Column) -> Column:
    return F.rlike(code, F.lit(C.CONTROL_CHARACTERS))


def quality_flags(code: Column, autogenerated: bool = True, minified: bool = True) -> dict:
    """The four quality findings; two of them can be switched off."""
    off = F.lit(False)
    return {
        "autogenerated": has_autogenerated_notice(code) if autogenerated else off,
        "suspicious": has_suspicious_characters(code),
        "minified": looks_minified(code) if minified else off,
        "repetitive": has_excessive_repetition(code),
    }


def passes_quality(code: Column, **toggles) -> Column:
    return ~reduce(Column.__or__, quality_flags(code, **toggles).values())


def normalize_names(df: DataFrame) -> DataFrame:
    """Write the filters' normalized language and license back."""
    return df.withColumns({"language": filter_language_name(F.col("language")),
                           "license": normalize_license(F.col("license"))})


def filter_reason(**toggles) -> Column:
    """First failing filter of a cleaned, normalized sample; null when all pass.

    One CASE in order of cost: set lookups first, then the scans of the text.
    """
    output = F.col("output")
    return (F.when(is_empty(output), C.REASON_EMPTY)
            .when(has_binary_content(output), C.REASON_BINARY)
            .when(~language_allowed(F.col("language")), C.REASON_LANGUAGE)
            .when(~license_allowed(F.col("license")), C.REASON_LICENSE)
            .when(~passes_quality(output, **toggles), C.REASON_QUALITY))
