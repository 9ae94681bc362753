from pyspark.sql import functions as F

from siftloom.operators import validation as V
from siftloom.operators.unify import io_tests

SCHEMA = ("pos bigint, id string, dataset string, language string, license string,"
          " instruction string, input string, output string")


def frame(spark, *rows):
    base = {"id": "1", "dataset": "test", "language": "python", "license": "mit",
            "instruction": "Write code", "input": "", "output": "x = 1"}
    return spark.createDataFrame([{**base, "pos": i, **r} for i, r in enumerate(rows)], SCHEMA)


def test_token_limits(spark):
    df = frame(spark, *[{"instruction": "w " * n, "output": "x"} for n in (18, 19, 32767, 32768)])
    df = V.with_tokens(df)
    got = [r[0] for r in df.orderBy("pos").select(V.sample_errors(df)).collect()]
    assert got == [["Too few tokens (19)"], [], [], ["Too many tokens (32769)"]]


def test_staged_errors(spark):
    df = V.with_tokens(frame(spark, {"instruction": None, "language": None, "output": ""},
                             {"instruction": " ", "output": "　"}))
    got = [r[0] for r in df.orderBy("pos").select(V.sample_errors(df)).collect()]
    assert got[0] == ["instruction must be str", "language must be str"]
    assert got[1] == ["Instruction empty", "Output empty", "Too few tokens (1)"]
    narrow = df.drop("input", "license")
    assert narrow.select(V.sample_errors(narrow)).first()[0] == [
        "Missing field: input", "Missing field: license"]
    typed = df.withColumn("language", F.lit(1))
    assert "language must be str" in typed.select(V.sample_errors(typed)).first()[0]


def test_schema_errors(spark):
    df = frame(spark, {}, {"license": "unknown"}, {"language": "klingon", "output": " "},
               {f: "" for f in ("id", "dataset", "language", "license", "instruction", "output")})
    got = [r[0] for r in df.orderBy("pos").select(V.schema_errors()).collect()]
    assert got[0] == []
    assert got[1] == ["License should be specified if available"]
    assert got[2] == ["Field 'output' must be non-empty string",
                      "Language 'klingon' not in supported list", "Output cannot be empty"]
    assert len(got[3]) == 9


def test_detailed(spark):
    df = frame(spark, {"license": "unknown"}, {"output": ""}, {"language": "klingon"},
               {"instruction": "w " * 40000, "language": "zzz"}, {"id": None})
    rows = V.with_detailed_validation(df).orderBy("pos").collect()
    assert [r.is_valid for r in rows] == [True, False, True, False, False]
    assert rows[0].warnings == ["Sample is very short (5 tokens, min 20)"]
    assert rows[1].errors == ["Field 'output' is empty"] and rows[1].warnings == []
    assert rows[2].warnings[0] == "Language 'klingon' not in supported list"
    assert rows[3].errors == ["Sample exceeds max tokens (40003 > 32768)"]
    assert rows[3].warnings == ["Language 'zzz' not in supported list"]
    assert rows[4].errors == ["Field 'id' must be string, got null"]


def test_batch_counts_and_types(spark):
    good = {"instruction": "w " * 30}
    validated = V.with_detailed_validation(
        frame(spark, good, {"output": ""}, {"id": "", "output": ""}, good))
    assert V.validation_summary(validated).first().asDict() == {
        "total": 4, "valid": 2, "invalid": 2, "valid_percent": 50.0}
    messages = [r.message for r in V.validation_messages(validated, limit=2).collect()]
    assert messages == ["Sample 1: Field 'output' is empty", "Sample 2: Field 'id' is empty"]
    types = {(r.kind, r.type): r.n for r in V.message_types(validated).collect()}
    assert types == {("error", "Field 'output' is empty"): 2, ("error", "Field 'id' is empty"): 1}
    empty = V.validation_summary(validated.where("pos < 0")).first()
    assert empty.total == 0 and empty.valid_percent == 0.0


def test_tests_zip_to_the_shorter_list(spark):
    df = spark.createDataFrame([(["1", "2", "3"], ["a"]), (None, ["a"]), ([], [])],
                               "i array<string>, o array<string>")
    got = [[tuple(t) for t in r[0]] for r in df.select(io_tests(F.col("i"), F.col("o"))).collect()]
    assert got == [[("io", "1", "a")], [], []]
