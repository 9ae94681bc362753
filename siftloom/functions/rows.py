"""Keeping costly expressions from being computed more than once per row."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` reads it.

    Shared subexpressions are otherwise only recognized in plain projections, not
    in filters nor inside the branches of a CASE.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def settled(df: DataFrame, *names: str) -> DataFrame:
    """The frame with the named columns re-emitted by a generator.

    The optimizer moves a filter below the projection it reads and repeats that
    projection's expressions inside the filter, which for text cleaning or language
    detection multiplies the cost of a row. It does not move filters below a
    generator, so later filters read the values computed here.
    """
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names))))


def literal(text: str) -> str:
    """``text`` as a string literal in a SQL expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
