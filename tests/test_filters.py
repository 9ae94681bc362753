from pyspark.sql import functions as F

from siftloom.operators import filters
from siftloom.plans import jobs


def test_minified(column):
    lines = ["x" * 400] * 3
    cases = ["x" * 2001, "x" * 2000, "x" * 400, "\n".join(lines), "\n".join(lines + ["x" * 401]),
             "", "a\n" * 3]
    assert column(filters.looks_minified, cases) == [True, True, False, False, True, False, False]


def test_repetition(column):
    ten_of_three = "\n".join(["a", "b", "c"] + ["a"] * 7)
    cases = ["a\n" * 9, "a\n" * 10, ten_of_three, "a\n \n" * 10, "\n".join(map(str, range(20)))]
    assert column(filters.has_excessive_repetition, cases) == [False, True, False, True, False]


def test_notices_and_control_characters(column):
    assert column(filters.has_autogenerated_notice,
                  ["# DO NOT EDIT", "@Generated", "plain", "Auto-Generated"]) == [
        True, True, False, True]
    assert column(filters.has_suspicious_characters,
                  ["a\x07", "a\tb\r\n", "\x0b", "\x1f", "é"]) == [True, False, True, True, False]
    assert column(filters.has_binary_content, ["a\x00b", "ab"]) == [True, False]


def test_toggles(column):
    minified = ["x" * 2001]
    assert column(filters.passes_quality, minified) == [False]
    assert column(lambda c: filters.passes_quality(c, minified=False), minified) == [True]


def samples(spark, *rows):
    defaults = {"id": "1", "dataset": "d", "language": "python", "license": "mit",
                "instruction": "do it " * 10, "input": "", "output": "x = 1 # " + "word " * 20}
    return spark.createDataFrame([{**defaults, "pos": i, **row} for i, row in enumerate(rows)],
                                 "pos bigint, id string, dataset string, language string,"
                                 " license string, instruction string, input string,"
                                 " output string")


def test_first_failing_reason(spark):
    df = samples(
        spark, {}, {"output": " \n"}, {"output": "a\x00b"}, {"language": "klingon"},
        {"language": None}, {"license": "gpl-3.0"}, {"license": ""},
        {"output": "generated by x " * 5}, {"instruction": "", "output": "x"},
        {"language": "klingon", "license": "gpl", "output": "do not edit"})
    rows = jobs.decided(df).orderBy("pos").collect()
    assert [r.reasons for r in rows] == [
        [], ["Empty Output"], ["Binary Content"], ["Language Filter"], ["Language Filter"],
        ["License Filter"], ["License Filter"], ["Quality Filter"],
        ["Instruction empty", "Too few tokens (1)"], ["Language Filter"]]
    assert rows[0].token_count == 44 and rows[3].token_count is None


def test_writes_normalized_names_back(spark):
    accepted, rejected = jobs.prepared(samples(
        spark, {"language": " Golang ", "license": "MIT License"}, {"license": "nope"}))
    assert [(r.language, r.license) for r in accepted.collect()] == [("go", "mit")]
    assert rejected.count() == 1


def test_text_is_cleaned_once_per_row(spark):
    """Filters on the decision must not repeat the cleaning expressions."""
    accepted, _ = jobs.prepared(samples(spark, {}))
    plan = accepted._jdf.queryExecution().optimizedPlan().toString()
    blank_line_patterns = plan.count("{3,}")
    assert blank_line_patterns == 3, plan


def test_allowlists_are_parameters(spark):
    df = samples(spark, {"license": "gpl-3.0"})
    assert df.where(filters.license_allowed(F.col("license"), ["gpl-3.0"])).count() == 1


def test_minified_needs_no_lines(spark, column, capsys):
    texts = ["", "\n", "x", "x" * 2001, "x" * 2001 + "\r\n", "\r\n".join(["x" * 401] * 5), "\n".join(["x" * 401] * 5),
             "\n".join(["x" * 400] * 5) + "\n", "\r".join(["x" * 500] * 4), "a\r\r\nb" + "x" * 2000,
             " ".join(["x" * 390] * 6), "\n" * 9 + "x" * 4001, "\n" * 9 + "x" * 3600, None]

    def by_lines(text):
        lines = text.splitlines()
        return len(lines) <= 2 and len(text) > 2000 or len("".join(lines)) > 400 * len(lines)
    assert column(filters.looks_minified, texts) == [None if t is None else by_lines(t) for t in texts]
    # the lines are counted, not made
    spark.createDataFrame([("a",)], "v string").select(filters.looks_minified(F.col("v"))).explain()
    assert "split(" not in capsys.readouterr().out
