import json

import pytest
from pyspark.sql import functions as F

from siftloom.plans import jobs
from siftloom.schema import RAW, UNIFIED
from siftloom.sources import adapters, readers
from siftloom.sources.registry import (DEFAULT_SOURCES, Source, registry_frame, select_sources,
                                       source_summary)

BY_ID = {s.id: s for s in DEFAULT_SOURCES}


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict(recursive=True)


def test_registry(spark):
    assert [s.id for s in DEFAULT_SOURCES] == [
        "mbpp", "apps", "humaneval", "codealpaca", "evolcode", "taco"]
    assert BY_ID["humaneval"].info()["name"] == "humaneval"
    assert "openai" in BY_ID["humaneval"].source_url
    chosen = select_sources(enabled=["apps", "taco"], disabled=["taco"])
    assert [s.id for s in chosen] == ["apps"]
    assert [s.id for s in select_sources(disabled=["mbpp"])][0] == "apps"
    off = [Source("x", "X", "h/x", "d", enabled=False)]
    assert select_sources(off) == []
    assert source_summary(registry_frame(spark)).count() == 6


def test_formats_and_splits(spark, tmp_path):
    df = spark.createDataFrame([("1", "do", "x", "y")], RAW["codealpaca"]).coalesce(1)
    df.write.json(f"{tmp_path}/a/train")
    df.write.option("header", "true").csv(f"{tmp_path}/a/test")
    fmt, files = readers.find_files(spark, f"{tmp_path}/a", "train", RAW["codealpaca"])
    assert fmt == "json" and len(files) == 1
    df.write.parquet(f"{tmp_path}/a/validation")
    fmt, files = readers.find_files(spark, f"{tmp_path}/a", "train", RAW["codealpaca"])
    assert fmt == "parquet" and "validation" in files[0]
    df.write.parquet(f"{tmp_path}/a/train2")
    _, files = readers.find_files(spark, f"{tmp_path}/a", "train", RAW["codealpaca"])
    assert len(files) == 1 and "train2" in files[0]
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        readers.find_files(spark, f"{tmp_path}/empty", "train", RAW["codealpaca"])


def test_checks(spark):
    df = spark.createDataFrame([("1", "do", "y")], "id string, instruction string, output string")
    assert readers.schema_problems(df, "evolcode") == []
    assert readers.check(df.drop("id"), "evolcode") is not None
    with pytest.raises(ValueError, match="missing column output"):
        readers.check(df.drop("output"), "evolcode")
    with pytest.raises(ValueError):
        readers.check(None, "evolcode")
    assert [tuple(r) for r in readers.inspect_schema(df).collect()] == [
        ("id", "string"), ("instruction", "string"), ("output", "string")]


def test_positions_follow_files_not_partitions(spark, tmp_path):
    for name in ("b", "a"):
        (spark.range(50).select(F.concat(F.lit(name), "id").alias("v")).coalesce(1)
         .write.parquet(f"{tmp_path}/{name}"))
    files = [f"{tmp_path}/a", f"{tmp_path}/b"]
    df = spark.read.parquet(*files)
    placed = readers.with_file_position(df, 2)
    rows = [r.v for r in placed.orderBy("pos").collect()]
    assert rows == [f"a{i}" for i in range(50)] + [f"b{i}" for i in range(50)]
    assert placed.agg(F.min("pos")).first()[0] == 2 << (readers.ROW_BITS + readers.FILE_BITS)
    again = readers.with_file_position(spark.read.parquet(*reversed(files)), 2).repartition(7)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, placed.collect()))


def test_text_formats_get_unique_positions(spark, tmp_path):
    same = spark.createDataFrame([("1", "do", "", "y")] * 4, RAW["codealpaca"])
    same.write.json(f"{tmp_path}/s")
    source = BY_ID["codealpaca"].at(f"{tmp_path}/s")
    placed = readers.with_position(readers.load(spark, source), source, 0)
    assert placed.select("pos").distinct().count() == 4


def test_mbpp(spark):
    raw = spark.createDataFrame([(1, " Add ", "def f(): pass\n", ["assert f()"]),
                                 (2, " \n", "x", None), (3, None, "x", None)], RAW["mbpp"])
    row = one(adapters.mbpp(raw))
    assert (row["id"], row["instruction"], row["output"], row["difficulty"]) == (
        "1", "Add", "def f(): pass", "easy")
    assert row["tests"] == [{"kind": "assert", "input": "assert f()", "expected": None}]
    assert row["metadata"] == {"test_count": "1"} and row["license"] == "cc-by-4.0"
    assert [f.name for f in adapters.mbpp(raw).schema] == [f.name for f in UNIFIED]


def test_apps(spark):
    cases = json.dumps({"inputs": ["1", "2", "3"], "outputs": ["a"]})
    raw = spark.createDataFrame(
        [(7, "Q", '["", "print(1)"]', "def s():", "Hard", cases),
         (8, "Q", "[]", None, None, None), (9, "", "x", None, None, None)], RAW["apps"])
    row = one(adapters.apps(raw))
    assert row["input"] == "Q\n\nStarter Code:\ndef s():" and row["output"] == "print(1)"
    assert row["difficulty"] == "hard" and row["language"] == "python"
    assert [t["expected"] for t in row["tests"]] == ["a"]
    assert row["metadata"] == {"test_count": "1", "has_starter": "true"}
    typed = raw.withColumn("input_output", F.from_json(
        "input_output", "inputs array<string>, outputs array<string>"))
    assert one(adapters.apps(typed))["tests"] == row["tests"]


def test_typed_solutions(spark):
    raw = spark.createDataFrame([("1", "Q", ["", "print(1)"], "EASY", None)],
                                "problem_id string, question string, solutions array<string>,"
                                " difficulty string, test_list array<string>")
    assert one(adapters.taco(raw))["output"] == "print(1)"
    struct = raw.withColumn("solutions", F.struct(F.lit("print(2)").alias("code")))
    assert one(adapters.taco(struct))["output"] == "print(2)"


def test_humaneval(spark):
    raw = spark.createDataFrame(
        [("HumanEval/0", "def foo():", "    return 1", "assert foo() == 1", "foo")],
        RAW["humaneval"])
    row = one(adapters.humaneval(raw))
    assert (row["language"], row["dataset"], row["output"]) == ("python", "humaneval", "return 1")
    assert row["metadata"] == {"entry_point": "foo", "tests": "assert foo() == 1",
                               "source": "openai"}


def test_instruction_sets(spark):
    raw = spark.createDataFrame([(None, "do it", None, "<?php echo $x; namespace A;"),
                                 ("5", "do it", " ctx ", "nothing to see")], RAW["codealpaca"])
    rows = {r.output: r for r in adapters.codealpaca(raw).collect()}
    first, second = rows["<?php echo $x; namespace A;"], rows["nothing to see"]
    assert first.language == "php" and len(first.id) == 32 and first.input == ""
    assert second.language == "unknown" and second.id == "5" and second.input == "ctx"
    evolved = adapters.evolcode(raw.drop("input", "id")).where("output like 'nothing%'").first()
    assert evolved.language == "python" and evolved.license == "cc-by-nc-sa-4.0"


def test_taco(spark):
    raw = spark.createDataFrame([("1", "Q", "print(1)", "EASY", ["t"]),
                                 ("2", "Q", "print(1)", "VERY_HARD", None)], RAW["taco"])
    rows = {r.id: r for r in adapters.taco(raw).collect()}
    assert rows["1"].difficulty == "easy" and len(rows["1"].tests) == 1
    assert rows["2"].difficulty == "unknown" and rows["2"].metadata == {"test_count": "0"}


def test_custom_and_row_adapters(spark):
    @adapters.register("upper")
    def upper(df):
        return adapters.mbpp(df.withColumn("text", F.upper("text")))

    raw = spark.createDataFrame([(1, "add", "x = 1", [])], RAW["mbpp"])
    assert one(adapters.ADAPTERS.pop("upper")(raw))["instruction"] == "ADD"

    def convert(row):
        return None if row["task_id"] == 2 else {
            "id": "1", "dataset": "d", "language": "c", "license": "mit", "instruction": "i",
            "input": "", "output": row["code"], "tests": [], "difficulty": "easy",
            "metadata": {}}
    two = raw.unionByName(spark.createDataFrame([(2, "add", "y", [])], RAW["mbpp"]))
    assert one(adapters.row_adapter(convert)(two))["output"] == "x = 1"


def test_backfill(spark):
    df = spark.createDataFrame(
        [("mbpp", "N/A", "none"), ("codealpaca", "unknown", None), ("other", "", ""),
         ("apps", "go", "isc")], "dataset string, language string, license string")
    rows = {r.dataset: (r.language, r.license)
            for r in adapters.backfill(df, registry_frame(spark)).collect()}
    assert rows == {"mbpp": ("python", "cc-by-4.0"), "codealpaca": ("unknown", "cc-by-4.0"),
                    "other": ("", ""), "apps": ("go", "isc")}


def test_defaults_follow_the_entry(spark, tmp_path):
    raw = spark.createDataFrame([("1", "do it", "", "nothing to see")], RAW["codealpaca"])
    raw.write.parquet(f"{tmp_path}/a")
    base = BY_ID["codealpaca"]
    entries = [base.at(f"{tmp_path}/a"),
               base.at(f"{tmp_path}/a", id="mine", adapter="codealpaca", language="python")]
    rows = jobs.unified(spark, entries).orderBy("dataset_ord").collect()
    assert [r.language for r in rows] == ["unknown", "python"]


def test_json_arrays_and_broken_lines(spark, tmp_path):
    records = [{"id": str(i), "instruction": "do", "input": "", "output": f"x{i}"}
               for i in range(5)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "train.json").write_text(json.dumps(records, indent=4))
    source = BY_ID["codealpaca"].at(f"{tmp_path}/a", layout="array")
    assert sorted(r.output for r in readers.load(spark, source).collect()) == [
        f"x{i}" for i in range(5)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "train.jsonl").write_text(json.dumps(records[0]) + '\n{"id": "1", broken\n')
    with pytest.raises(Exception, match="[Mm]alformed|FAILFAST|MALFORMED|CANNOT"):
        readers.load(spark, BY_ID["codealpaca"].at(f"{tmp_path}/b")).collect()


def test_csv_is_bound_by_its_header(spark, tmp_path):
    df = spark.createDataFrame([("add", "1 2", "print(3)\nprint(4)")],
                               "instruction string, input string, output string")
    df.select("output", "instruction", "input").write.option("header", "true").option(
        "escape", '"').csv(f"{tmp_path}/c")
    row = one(readers.load(spark, BY_ID["codealpaca"].at(f"{tmp_path}/c")))
    assert row == {"instruction": "add", "input": "1 2", "output": "print(3)\nprint(4)"}


def test_missing_columns_and_wider_types(spark, tmp_path):
    wide = spark.createDataFrame([(5, "Q", ["print(1)"], None, "easy", None)],
                                 "problem_id bigint, question string, solutions array<string>,"
                                 " starter_code string, difficulty string, input_output string")
    wide.write.parquet(f"{tmp_path}/w")
    source = BY_ID["apps"].at(f"{tmp_path}/w")
    assert readers.load(spark, source).schema["problem_id"].dataType.typeName() == "long"
    wide.drop("question").write.parquet(f"{tmp_path}/m")
    with pytest.raises(ValueError, match="missing column question"):
        list(readers.load_all(spark, [BY_ID["apps"].at(f"{tmp_path}/m")]))


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_columns_of_later_files_are_read(spark, tmp_path, fmt):
    wide = spark.createDataFrame([("7", "do", "context", "y")], RAW["codealpaca"]).coalesce(1)
    for name, df in (("a", wide.drop("id", "input")), ("b", wide), ("c", wide.drop("input"))):
        df.write.option("header", "true").format(fmt).save(f"{tmp_path}/u/{name}")
    source = BY_ID["codealpaca"].at(f"{tmp_path}/u")
    raw = readers.load(spark, source)
    assert sorted(map(tuple, raw.select("id", "input", "output").collect()), key=str) == [
        ("7", "context", "y"), ("7", None, "y"), (None, None, "y")]
    rows = jobs.unified(spark, [source]).collect()
    assert sorted(r.input for r in rows) == ["", "", "context"]
    assert [r.id for r in rows].count("7") == 2


def test_numbers_of_later_files_may_be_wider(spark, tmp_path):
    narrow = spark.createDataFrame([(1, "add", "x = 1", ["t"])], RAW["mbpp"]).coalesce(1)
    narrow.write.parquet(f"{tmp_path}/n/a")
    narrow.withColumn("task_id", F.lit(1 << 40)).write.parquet(f"{tmp_path}/n/b")
    raw = readers.load(spark, BY_ID["mbpp"].at(f"{tmp_path}/n"))
    assert sorted(r.task_id for r in raw.collect()) == [1, 1 << 40]
    narrow.withColumn("task_id", F.lit("x")).write.parquet(f"{tmp_path}/n/c")
    with pytest.raises(ValueError, match="task_id is"):
        readers.load(spark, BY_ID["mbpp"].at(f"{tmp_path}/n"))


def test_streams_read_their_split(spark, tmp_path):
    df = spark.createDataFrame([("1", "do", "", "y")], RAW["codealpaca"])
    df.write.parquet(f"{tmp_path}/s/train")
    df.withColumn("output", F.lit("wrong")).write.parquet(f"{tmp_path}/s/test")
    source = BY_ID["codealpaca"].at(f"{tmp_path}/s", streaming=True)
    query = (readers.load(spark, source).writeStream.format("memory").queryName("split_rows")
             .option("checkpointLocation", f"{tmp_path}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert [r.output for r in spark.table("split_rows").collect()] == ["y"]


def test_positions_beyond_their_bits_fail(spark, tmp_path):
    df = spark.createDataFrame([(1 << 57,)], "n bigint")
    source = Source("x", "X", "h/x", "d", order_by="n")
    with pytest.raises(Exception, match="more than 56 bits"):
        readers.with_position(df, source, 0).collect()


def test_resume(spark):
    df = spark.createDataFrame([("d", "1"), ("d", "2"), ("e", "1")], "dataset string, id string")
    left = jobs.not_yet_written(df, df.where("id = '1' AND dataset = 'd'"))
    assert sorted(map(tuple, left.collect())) == [("d", "2"), ("e", "1")]
