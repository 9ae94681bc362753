"""First usable solution of a text, JSON list or JSON object field."""

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftloom.constants import SOLUTION_KEYS
from siftloom.functions.text import strip

_STRICT_JSON = {"allowSingleQuotes": "false"}
_JSON_SCALAR = (r"\A(?:-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
                r"|true|false|null|NaN|-?Infinity)\z")


def _first_leaf(text):
    """First non-empty string reached by decoding nested JSON depth first."""
    pending = [text]
    while pending:
        node = pending.pop()
        if isinstance(node, str):
            leaf = node.strip()
            if leaf:
                try:
                    pending.append(json.loads(leaf))
                except (ValueError, RecursionError):
                    return leaf.encode("utf-8", "ignore").decode("utf-8")
        elif isinstance(node, list):
            pending.extend(reversed(node))
        elif isinstance(node, dict):
            pending.extend(node[key] for key in reversed(SOLUTION_KEYS) if key in node)
    return None


@F.arrow_udf(T.StringType())
def _nested_solution(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else _first_leaf(v) for v in values.to_pylist()],
                    pa.string())


def _may_be_json(c: Column) -> Column:
    return F.substring(c, 1, 1).isin("[", "{", '"') | F.rlike(c, F.lit(_JSON_SCALAR))


def first_solution(c: Column) -> Column:
    """Built-in path for plain text and lists of plain texts.

    List items are themselves decoded when they are JSON, so a nested list or
    object reads the same as a text holding it. Only rows where that matters
    (objects, quoted text, lists whose first item is JSON again, text that merely
    starts like JSON) are handed to Python; all others pass it a null.
    """
    value = strip(c)
    wrapped = F.from_json(F.concat(F.lit('{"v":'), value, F.lit("}")),
                          "v array<string>", _STRICT_JSON)
    items = F.filter(wrapped["v"], lambda item: strip(item) != "")
    head = strip(F.get(items, 0))
    is_list = F.startswith(value, F.lit("[")) & items.isNotNull()
    simple_list = is_list & (head.isNull() | ~_may_be_json(head))
    nested = F.substring(value, 1, 1).isin("[", "{", '"') & ~F.coalesce(simple_list, F.lit(False))
    return (F.when(nested, _nested_solution(F.when(nested, value)))
            .when(simple_list, head)
            .when((value != "") & ~F.rlike(value, F.lit(_JSON_SCALAR)), value))
