"""The shared projection onto the unified schema, and its output shapes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom import constants as C
from siftloom.functions.text import lower_strip, strip
from siftloom.schema import TEST_CASE, UNIFIED

ENGINE_COLUMNS = ("dataset_ord", "pos")
_TESTS_TYPE = f"array<{TEST_CASE.simpleString()}>"


def text(name: str) -> Column:
    """Stripped field; a null counts as ''."""
    return strip(F.coalesce(F.col(name).cast("string"), F.lit("")))


def no_tests() -> Column:
    return F.array().cast(_TESTS_TYPE)


def assert_tests(items: Column) -> Column:
    """Test statements given as text."""
    return F.transform(
        F.coalesce(items, F.array().cast("array<string>")),
        lambda item: F.struct(F.lit("assert").alias("kind"), item.alias("input"),
                              F.lit(None).cast("string").alias("expected")))


def io_tests(inputs: Column, outputs: Column) -> Column:
    """Input/output pairs up to the shorter list; none when either list is missing."""
    size = F.least(F.size(inputs), F.size(outputs))
    pairs = F.arrays_zip(F.slice(inputs, 1, size).alias("i"), F.slice(outputs, 1, size).alias("o"))
    zipped = F.transform(pairs, lambda pair: F.struct(
        F.lit("io").alias("kind"), pair["i"].alias("input"), pair["o"].alias("expected")))
    return F.when(inputs.isNotNull() & outputs.isNotNull(), zipped).otherwise(no_tests())


def normalize_difficulty(c: Column) -> Column:
    name = lower_strip(c.cast("string"))
    return F.when(name.isin(*C.DIFFICULTIES), name).otherwise(F.lit(C.UNKNOWN))


def metadata(**entries: Column) -> Column:
    pairs = [x for key, value in entries.items() for x in (F.lit(key), value.cast("string"))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def to_unified(df: DataFrame, dataset: str, id: Column, instruction: Column, output: Column,
               language: Column = None, license: str = C.UNKNOWN, input: Column = None,
               tests: Column = None, difficulty: Column = None, meta: Column = None) -> DataFrame:
    """Project a source onto the unified schema, trimming and filling defaults.

    A sample without an id is identified by its content, so splits and resumed
    runs stay stable. ``dataset_ord`` and ``pos`` are carried along if present.
    """
    fields = {
        "instruction": strip(instruction),
        "input": strip(F.coalesce(input, F.lit(""))) if input is not None else F.lit(""),
        "output": strip(output),
    }
    given = F.coalesce(id.cast("string"), F.lit(""))
    columns = {
        "id": F.when(given != "", given)
               .otherwise(F.md5(F.concat_ws("\x1f", *fields.values()))),
        "dataset": F.lit(dataset),
        "language": lower_strip(F.lit(C.UNKNOWN) if language is None else language),
        "license": F.lit(license.lower().strip()),
        **fields,
        "tests": no_tests() if tests is None else tests,
        "difficulty": F.lit(C.UNKNOWN) if difficulty is None else difficulty,
        "metadata": metadata() if meta is None else meta,
    }
    carried = [F.col(name) for name in ENGINE_COLUMNS if name in df.columns]
    return df.select(*carried, *[columns[f.name].alias(f.name) for f in UNIFIED.fields])


def to_json_rows(df: DataFrame) -> DataFrame:
    """Each sample as one JSON text with every field present."""
    return df.select(F.to_json(F.struct(*[f.name for f in UNIFIED.fields if f.name in df.columns]),
                               {"ignoreNullFields": "false"}).alias("json"))


def instruction_form(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, "instruction", "input", "output")


def chat_form(df: DataFrame, *keep: str) -> DataFrame:
    user = F.concat(F.col("instruction"),
                    F.when(F.col("input") != "", F.concat(F.lit("\n\n"), F.col("input")))
                    .otherwise(F.lit("")))

    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return df.select(*keep, F.array(message("user", user),
                                    message("assistant", F.col("output"))).alias("messages"))


def export_form(df: DataFrame, form: str = "instruction", *keep: str) -> DataFrame:
    return chat_form(df, *keep) if form == "chat" else instruction_form(df, *keep)
