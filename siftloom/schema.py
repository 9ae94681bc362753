"""Declared schemas: the unified sample and the six raw sources."""

from pyspark.sql import types as T

_str = T.StringType()


def _fields(**kinds):
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


TEST_CASE = _fields(kind=_str, input=_str, expected=_str)

UNIFIED = T.StructType([
    T.StructField("id", _str, False),
    T.StructField("dataset", _str, False),
    T.StructField("language", _str),
    T.StructField("license", _str),
    T.StructField("instruction", _str),
    T.StructField("input", _str, False),
    T.StructField("output", _str),
    T.StructField("tests", T.ArrayType(TEST_CASE)),
    T.StructField("difficulty", _str),
    T.StructField("metadata", T.MapType(_str, _str)),
])

TEXT_FIELDS = ("instruction", "input", "output")

RAW = {
    "mbpp": _fields(task_id=T.IntegerType(), text=_str, code=_str,
                    test_list=T.ArrayType(_str)),
    "apps": _fields(problem_id=T.IntegerType(), question=_str, solutions=_str,
                    starter_code=_str, difficulty=_str, input_output=_str),
    "humaneval": _fields(task_id=_str, prompt=_str, canonical_solution=_str,
                         test=_str, entry_point=_str),
    "codealpaca": _fields(id=_str, instruction=_str, input=_str, output=_str),
    "evolcode": _fields(id=_str, instruction=_str, output=_str),
    "taco": _fields(problem_id=_str, question=_str, solutions=_str,
                    difficulty=_str, test_list=T.ArrayType(_str)),
}

# columns a source may leave out; everything else in RAW is required
OPTIONAL = {"codealpaca": {"id", "input"}, "evolcode": {"id"},
            "taco": {"problem_id", "test_list"}}

# columns that come as JSON text or as typed values
TYPED = {"solutions", "input_output"}
