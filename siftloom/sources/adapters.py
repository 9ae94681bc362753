"""One DataFrame-to-DataFrame adapter per source kind, and a registry of them."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom import constants as C
from siftloom.functions.language import with_language
from siftloom.functions.rows import settled
from siftloom.functions.solutions import first_solution
from siftloom.functions.text import strip
from siftloom.operators.unify import (assert_tests, io_tests, metadata, no_tests,
                                      normalize_difficulty, text, to_unified)
from siftloom.schema import UNIFIED

Adapter = Callable[[DataFrame], DataFrame]
ADAPTERS: dict[str, Adapter] = {}


def register(name: str):
    """Decorator: make a ``DataFrame -> DataFrame`` function the adapter called ``name``."""
    def add(adapter: Adapter) -> Adapter:
        ADAPTERS[name] = adapter
        return adapter
    return add


def row_adapter(convert: Callable[[dict], dict | None]) -> Adapter:
    """Adapter from a row-level Python function; None drops the row.

    For sources no column expression can read; runs on Arrow batches.
    """
    names = [f.name for f in UNIFIED.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            samples = [s for s in map(convert, batch.to_dict("records")) if s is not None]
            yield pd.DataFrame(samples, columns=names)

    return lambda df: df.mapInPandas(run, UNIFIED)


def _optional(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _present(*names: str):
    condition = F.lit(True)
    for name in names:
        condition = condition & (text(name) != "")
    return condition


def _solved(df: DataFrame) -> DataFrame:
    """Rows with a question and a usable solution, the latter as ``_solution``."""
    solutions = F.col("solutions")
    if df.schema["solutions"].dataType.typeName() != "string":
        # typed lists, structs and maps read as the JSON text that holds the same
        solutions = F.to_json(solutions)
    found = df.where(_present("question")).withColumn("_solution", first_solution(solutions))
    return settled(found, "_solution").where(F.col("_solution").isNotNull())


def _detected(df: DataFrame, code: str, default: str | None) -> DataFrame:
    """Language of the code column as ``_language``; an undetected one takes the default."""
    found = with_language(df, code, "_language")
    if default is None:
        return found
    name = F.col("_language")
    return found.withColumn("_language", F.when(name == C.UNKNOWN, default).otherwise(name))


@register("mbpp")
def mbpp(df: DataFrame) -> DataFrame:
    return to_unified(
        df.where(_present("text", "code")), "mbpp", F.col("task_id"),
        text("text"), text("code"), F.lit("python"), "cc-by-4.0",
        tests=assert_tests(F.col("test_list")), difficulty=F.lit("easy"),
        meta=metadata(test_count=F.coalesce(F.array_size("test_list"), F.lit(0))))


def _apps_tests(df: DataFrame):
    """Inputs and outputs of the test field, given as a struct or as JSON text."""
    if df.schema["input_output"].dataType.typeName() == "string":
        cases = F.from_json("input_output", "inputs array<string>, outputs array<string>")
    else:
        cases = F.col("input_output")
    return io_tests(cases["inputs"], cases["outputs"])


@register("apps")
def apps(df: DataFrame) -> DataFrame:
    solved = (_solved(df).withColumn("_tests", _apps_tests(df))
              .withColumn("_starter", text("starter_code")))
    has_starter = F.col("_starter") != ""
    prompt = F.concat(text("question"), F.when(
        has_starter, F.concat(F.lit(C.STARTER_HEADING), F.col("_starter"))).otherwise(F.lit("")))
    return to_unified(
        _detected(solved, "_solution", "python"), "apps", F.col("problem_id"),
        F.lit(C.SOLVE_INSTRUCTION), F.col("_solution"), F.col("_language"), "mit",
        input=prompt, tests=F.col("_tests"),
        difficulty=normalize_difficulty(F.col("difficulty")),
        meta=metadata(test_count=F.size("_tests"), has_starter=has_starter))


@register("humaneval")
def humaneval(df: DataFrame) -> DataFrame:
    return to_unified(
        df.where(_present("prompt", "canonical_solution")), "humaneval", F.col("task_id"),
        F.lit(C.SPECIFICATION_INSTRUCTION), text("canonical_solution"), F.lit("python"), "mit",
        input=text("prompt"), difficulty=F.lit("medium"),
        meta=metadata(entry_point=F.coalesce("entry_point", F.lit("")), tests=text("test"),
                      source=F.lit("openai")))


@register("codealpaca")
def codealpaca(df: DataFrame) -> DataFrame:
    found = _detected(df.where(_present("instruction", "output"))
                      .withColumn("_code", text("output")), "_code", None)
    return to_unified(found, "codealpaca", _optional(df, "id"), text("instruction"),
                      F.col("_code"), F.col("_language"), "cc-by-4.0",
                      input=strip(F.coalesce(_optional(df, "input"), F.lit(""))))


@register("evolcode")
def evolcode(df: DataFrame) -> DataFrame:
    found = _detected(df.where(_present("instruction", "output"))
                      .withColumn("_code", text("output")), "_code", "python")
    return to_unified(found, "evolcode", _optional(df, "id"), text("instruction"),
                      F.col("_code"), F.col("_language"), "cc-by-nc-sa-4.0")


@register("taco")
def taco(df: DataFrame) -> DataFrame:
    tests = assert_tests(F.col("test_list")) if "test_list" in df.columns else no_tests()
    solved = _solved(df).withColumn("_tests", tests)
    return to_unified(
        _detected(solved, "_solution", "python"), "taco", _optional(df, "problem_id"),
        F.lit(C.SOLVE_INSTRUCTION), F.col("_solution"), F.col("_language"), "apache-2.0",
        input=text("question"), tests=F.col("_tests"),
        difficulty=normalize_difficulty(F.col("difficulty")),
        meta=metadata(test_count=F.size("_tests")))


def _filled(name: str, default):
    """The column, or the default where it names nothing; an empty default fills nothing."""
    given = F.lower(strip(F.coalesce(name, F.lit("none"))))
    return F.when(given.isin(*C.UNKNOWN_METADATA_VALUES) & (default != ""),
                  default).otherwise(F.col(name))


def with_defaults(df: DataFrame, source) -> DataFrame:
    """Fill in language and license by the entry the rows were read for."""
    return df.withColumns({name: _filled(name, F.lit(default)) for name, default in (
        ("language", source.language), ("license", source.license)) if default})


def backfill(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Replace a language or license that is not given by the default of its dataset.

    For tables that are merged already and know their entry by name only, so names must
    be unique. The registry has one row per configured source, so it is broadcast.
    """
    defaults = F.broadcast(registry.select(
        F.col("id").alias("_id"), F.col("language").alias("_language"),
        F.col("license").alias("_license")).dropDuplicates(["_id"]))
    joined = df.join(defaults, df["dataset"] == F.col("_id"), "left")
    return (joined.withColumns({name: _filled(name, F.col(f"_{name}"))
                                for name in ("language", "license")})
            .drop("_id", "_language", "_license"))
