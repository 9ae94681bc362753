import json
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siftloom.operators import sampling, statistics, unify
from siftloom.operators.index import BucketIndex
from siftloom.plans import jobs
from siftloom.schema import RAW, UNIFIED
from siftloom.sinks import reports, writers
from siftloom.sources.registry import DEFAULT_SOURCES
from siftloom.streaming import incremental


def corpus(spark, n=40):
    df = spark.range(n).select(
        F.col("id").alias("pos"), F.col("id").cast("string").alias("id"),
        F.lit("test").alias("dataset"), F.lit("python").alias("language"),
        F.lit("mit").alias("license"), F.lit("Tést").alias("instruction"),
        F.when(F.col("id") % 2 == 0, "ctx").otherwise("").alias("input"),
        F.concat(F.lit("output "), "id").alias("output"), unify.no_tests().alias("tests"),
        F.lit("easy").alias("difficulty"), unify.metadata().alias("metadata"))
    return df.withColumn("token_count", F.lit(3).cast("bigint"))


def test_jsonl_lines(spark, tmp_path):
    df = corpus(spark, 3).select(*[f.name for f in UNIFIED])
    writers.write_corpus(df, "JSONL", f"{tmp_path}/j")
    lines = [line for f in (tmp_path / "j").glob("*.json") for line in
             f.read_text(encoding="utf8").splitlines()]
    assert len(lines) == 3 and "Tést" in lines[0] and json.loads(lines[0])["language"] == "python"
    writers.write_corpus(df, "jsonl", f"{tmp_path}/j", mode="append", compression="gzip")
    assert writers.read_back(spark, "json", f"{tmp_path}/j", df.schema).count() == 6
    assert list((tmp_path / "j").glob("*.json.gz"))


def test_formats(spark, tmp_path):
    df = corpus(spark, 5).drop("tests", "metadata")
    writers.write_corpus(df, "parquet", f"{tmp_path}/p", compression="gzip")
    info = writers.export_info(spark, "parquet", f"{tmp_path}/p", df.schema).first()
    size = sum(f.stat().st_size for f in (tmp_path / "p").glob("*.parquet"))
    assert (info.samples, info.file_size, info.compression) == (5, size, "gzip")
    with pytest.raises(ValueError, match="unknown export format"):
        writers.write_corpus(df, "xyz", f"{tmp_path}/x")

    @writers.register_writer("lines")
    def write_lines(df, path, mode, compression):
        df.select(F.col("output").alias("value")).write.mode(mode).text(path)
    writers.write_corpus(df, "lines", f"{tmp_path}/l")
    assert spark.read.text(f"{tmp_path}/l").count() == 5
    writers.WRITERS.pop("lines")


def test_codecs_are_read_from_the_files(spark, tmp_path):
    df = corpus(spark, 6).drop("tests", "metadata")
    for fmt, codec, kind in (("parquet", None, "snappy"), ("parquet", "zstd", "zstd"), ("parquet", "lz4_raw", "lz4_raw"),
                             ("parquet", "none", "none"), ("jsonl", None, "none"), ("jsonl", "bzip2", "bzip2"),
                             ("jsonl", "deflate", "deflate")):
        path = f"{tmp_path}/{fmt}-{codec}"
        writers.write_corpus(df.repartition(2), fmt, path, compression=codec)
        files = writers.export_files(spark, fmt, path, df.schema).collect()
        assert {r.compression for r in files} == {kind} and sum(r.rows for r in files) == 6
    writers.write_corpus(df, "parquet", f"{tmp_path}/parquet-zstd", mode="append", compression="gzip")
    assert writers.export_info(spark, "parquet", f"{tmp_path}/parquet-zstd", df.schema).first().compression == "gzip,zstd"


def test_split_is_written_in_one_pass(spark, tmp_path, monkeypatch):
    df = sampling.with_split(corpus(spark, 400), fraction=0.3)
    calls = []
    monkeypatch.setattr(writers, "write_corpus", lambda rows, *a, **k: calls.append((rows, k)))
    writers.write_split(df, f"{tmp_path}/out")
    assert len(calls) == 1 and calls[0][1]["partition_by"] == "split"
    monkeypatch.undo()
    for even in (False, True):
        writers.write_split(df.repartition(7), f"{tmp_path}/out", even=even)
        back = spark.read.json(f"{tmp_path}/out")
        assert back.count() == 400 and back.select("split").distinct().count() == 2

    @writers.register_writer("plain")
    def write_plain(rows, path, mode, compression):
        rows.select(F.col("output").alias("value")).write.mode(mode).text(path)
    writers.write_split(df, f"{tmp_path}/plain", fmt="plain")
    assert spark.read.text(f"{tmp_path}/plain").count() == 400
    writers.WRITERS.pop("plain")


def test_chat_and_instruction_forms(spark):
    chat = {r.id: r.messages for r in unify.export_form(corpus(spark, 2), "chat", "id").collect()}
    assert [tuple(m) for m in chat["0"]] == [("user", "Tést\n\nctx"), ("assistant", "output 0")]
    assert chat["1"][0].content == "Tést"
    assert unify.export_form(corpus(spark, 1)).columns == ["instruction", "input", "output"]
    row = json.loads(unify.to_json_rows(corpus(spark, 1)).first().json)
    assert list(row) == [f.name for f in UNIFIED] and row["tests"] == []


def test_split_is_stable_and_near_its_fraction(spark, tmp_path):
    df = sampling.with_split(corpus(spark, 5000), fraction=0.1)
    counts = {r.split: r.n for r in sampling.split_counts(df).collect()}
    assert 380 < counts["validation"] < 620
    again = sampling.with_split(corpus(spark, 5000).repartition(9), fraction=0.1)
    assert df.select("id", "split").exceptAll(again.select("id", "split")).count() == 0
    writers.write_split(df, f"{tmp_path}/out", "chat")
    back = spark.read.json(f"{tmp_path}/out")
    assert {r.split: r["count"] for r in back.groupBy("split").count().collect()} == counts


def test_shuffle_rank_is_the_place_in_the_sorted_order(spark):
    df = spark.range(500)
    order = [r.id for r in sampling.shuffled(df, "id").collect()]
    ranks = {r.id: r.shuffle_rank for r in sampling.shuffle_rank(df.repartition(5), "id").collect()}
    assert [ranks[i] for i in order] == list(range(1, 501)) and order != sorted(order)
    assert order != [r.id for r in sampling.shuffled(df, "id", seed=1).collect()]


def test_statistics(spark):
    df = corpus(spark, 4)
    assert statistics.run_statistics(df).first().asDict() == {
        "samples": 4, "tokens": 12, "average_tokens": 3.0, "longest": 3, "shortest": 3}
    empty = statistics.run_statistics(df.where("pos < 0")).first().asDict()
    assert empty == {"samples": 0, "tokens": 0, "average_tokens": 0.0, "longest": 0,
                     "shortest": 0}
    nulls = df.withColumn("language", F.lit(None).cast("string"))
    assert [tuple(r) for r in statistics.count_by(nulls, "language").collect()] == [
        ("language", "unknown", 4)]
    assert {tuple(r) for r in statistics.per_dataset(df).collect()} == {
        ("test", "language", "python", 4), ("test", "license", "mit", 4)}
    top = statistics.top_with_share(df.withColumn("language", F.col("id")), "language", 2)
    assert [tuple(r) for r in top.collect()] == [("0", 1, 25.0), ("1", 1, 25.0)]


def test_summary_and_markdown(spark, tmp_path):
    share = spark.createDataFrame([(8, 7, 1, 12.5)],
                                  "processed int, unique int, removed int, duplicate_percentage double")
    summary = statistics.summary_record(corpus(spark, 4), share)
    row = summary.first()
    assert row.samples_per_dataset == {"test": 4} and row.duplicate_percentage == 12.5
    assert len(summary.columns) == 14
    text = reports.markdown(summary, datetime(2024, 1, 1))
    assert "Generated: 2024-01-01T00:00:00" in text and "| python | 4 | 100.0% |" in text
    assert "- **Total Samples**: 4" in text and "12.50%" in text
    reports.write_text(spark, text, f"{tmp_path}/report")
    writers.write_statistics(summary, f"{tmp_path}/stats")
    assert spark.read.json(f"{tmp_path}/stats").first().total_samples == 4


def raw_tables(spark, root):
    code = "def f(x):\n    return x + 1  # " + " ".join(f"w{i}" for i in range(40))
    spark.createDataFrame([(1, "Add one", code, ["assert f(1) == 2"]),
                           (2, "Add one again", code, []), (3, "", code, [])],
                          RAW["mbpp"]).write.parquet(f"{root}/mbpp/train")
    spark.createDataFrame([("a", "Explain", "", "x"), ("b", "Do nothing", "", "plain words " * 15)],
                          RAW["codealpaca"]).write.json(f"{root}/codealpaca")
    spark.createDataFrame([("e", "Evolve", code)], RAW["evolcode"]).write.parquet(
        f"{root}/evolcode")
    by_id = {s.id: s for s in DEFAULT_SOURCES}
    return [by_id[n].at(f"{root}/{n}") for n in ("mbpp", "codealpaca", "evolcode")]


def test_whole_run(spark, tmp_path):
    outcome = jobs.run(spark, raw_tables(spark, str(tmp_path / "in")), f"{tmp_path}/out", "chat")
    kept = outcome.corpus.collect()
    assert [(r.dataset, r.id) for r in kept] == [("mbpp", "1")]
    assert {r.reason: r.n for r in outcome.rejections.collect()} == {
        "Language Filter": 2, "License Filter": 1}
    assert outcome.decisions.first().asDict() == {"accepted": 2, "rejected": 3, "recorded": 3}
    assert outcome.duplicates.first().removed == 1
    assert outcome.run_statistics.first().samples == 1
    assert spark.read.json(f"{tmp_path}/out").count() == 1
    report = spark.read.text(f"{tmp_path}/out/_reports/run=0/report")
    assert {"- **Total Samples**: 1", "- **Duplicate Percentage**: 50.00%"} <= {
        r.value for r in report.collect()}
    stored = spark.read.json(f"{tmp_path}/out/_reports/run=0/statistics").first()
    assert (stored.total_samples, stored.duplicate_percentage) == (1, 50.0)
    assert set(reports.console_tables(outcome)) >= {"statistics", "rejections", "export"}
    jobs.run(spark, raw_tables(spark, str(tmp_path / "in2")), f"{tmp_path}/out", "chat")
    assert spark.read.json(f"{tmp_path}/out").count() == 1


LINE = "instruction string, input string, output string, split string, run int"


def code_rows(first, last):
    return [(i, f"Task {i}", f"def f{i}(x):\n    return x + {i}  # " + " ".join(f"w{i}v{j}" for j in range(40)), [])
            for i in range(first, last)]


def test_a_resumed_run_adds_what_is_new(spark, tmp_path):
    def source(name, rows):
        spark.createDataFrame(rows, RAW["mbpp"]).write.parquet(f"{tmp_path}/{name}/train")
        mbpp = next(s for s in DEFAULT_SOURCES if s.id == "mbpp")
        return [replace(mbpp.at(f"{tmp_path}/{name}"), order_by="task_id")]
    out = f"{tmp_path}/out"
    assert jobs.committed(spark, out, LINE).count() == 0
    jobs.run(spark, source("a", code_rows(0, 5)), out)
    copy = (9, "A copy", code_rows(3, 4)[0][2], [])
    more = source("b", code_rows(0, 8) + [copy])
    second = jobs.run(spark, more, out, resume=True)
    # five were decided before, one of the others is a copy of what the first run kept
    assert second.run == 1 and sorted(int(r.id) for r in second.corpus.collect()) == [5, 6, 7]
    assert second.duplicates.first().removed == 1
    written = jobs.committed(spark, out, LINE).collect()
    assert sorted(r.instruction for r in written) == [f"Task {i}" for i in range(8)]
    assert {r.run for r in written} == {0, 1}
    third = jobs.run(spark, more, out, resume=True)
    assert third.run == 2 and third.corpus.count() == 0
    assert jobs.committed(spark, out, LINE).count() == 8
    # without resume everything starts anew
    jobs.run(spark, source("c", code_rows(20, 22)), out)
    assert jobs.committed_runs(spark, out) == [0]
    assert spark.read.schema(LINE).json(out).count() == 2


def test_a_run_without_commit_does_not_count(spark, tmp_path, monkeypatch):
    def source(name, rows):
        spark.createDataFrame(rows, RAW["mbpp"]).write.parquet(f"{tmp_path}/{name}/train")
        mbpp = next(s for s in DEFAULT_SOURCES if s.id == "mbpp")
        return [replace(mbpp.at(f"{tmp_path}/{name}"), order_by="task_id")]
    out = f"{tmp_path}/out"
    jobs.run(spark, source("a", code_rows(0, 3)), out)

    def fail(*args):
        raise RuntimeError("lost")
    monkeypatch.setattr(jobs, "_commit", fail)
    more = source("b", code_rows(0, 6))
    with pytest.raises(RuntimeError, match="lost"):
        jobs.run(spark, more, out, resume=True)
    monkeypatch.undo()
    assert jobs.committed(spark, out, LINE).count() == 3
    again = jobs.run(spark, more, out, resume=True)
    assert again.run == 1 and sorted(int(r.id) for r in again.corpus.collect()) == [3, 4, 5]
    assert jobs.committed(spark, out, LINE).count() == 6


def test_index_reads_the_prefixes_asked_for(spark, tmp_path):
    def buckets(*numbers):
        return spark.createDataFrame([(n,) for n in numbers], "n int").select(
            F.unhex(F.md5(F.col("n").cast("string"))).alias("bucket"))
    index = BucketIndex(spark, f"{tmp_path}/index", live=2)
    assert index.lookup(buckets(1)) is None
    for version in range(5):
        index.add(version, buckets(*range(version * 100, version * 100 + 100)))
    # parts 0 and 1 were merged into 2, that and 3 into 4
    assert index.parts() == ["4"] and index.parts(before=4) == ["2", "3"]
    found = index.lookup(buckets(7, 450))
    assert len(found.inputFiles()) <= 256
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [prefix" in plan
    assert found.join(buckets(7, 450, 900), "bucket", "left_semi").count() == 2
    assert found.where("input_file_name() LIKE '%prefix=%'").select(
        F.input_file_name()).distinct().count() <= 2
    # a version is written again
    index.add(3, buckets(*range(300, 400)))
    assert index.lookup(buckets(350), before=4).join(buckets(350), "bucket", "left_semi").count() == 1
    assert index.lookup(buckets(450), before=4).join(buckets(450), "bucket", "left_semi").count() == 0


def batches(spark, folder, parts):
    """Write (pos, output) rows, one file per part, in arrival order."""
    import time
    for rows in parts:
        (spark.createDataFrame(rows, "pos bigint, output string").coalesce(1)
         .write.mode("append").parquet(folder))
        time.sleep(1.1)


def test_two_batches_equal_one_and_replay_changes_nothing(spark, tmp_path):
    words = [" ".join(f"{k}{i}" for i in range(60)) for k in "abc"]
    first = [(1, words[0]), (2, words[1]), (3, words[0])]
    second = [(4, words[1]), (5, words[2]), (6, words[2])]
    source = f"{tmp_path}/in"
    batches(spark, source, [first, second])
    stream = (spark.readStream.schema("pos bigint, output string")
              .option("maxFilesPerTrigger", 1).parquet(source))
    run_dir = f"{tmp_path}/run"
    incremental.dedup_stream(stream, run_dir).awaitTermination()
    found = incremental.deduplicated(spark, run_dir, "pos bigint, output string, batch_id int")
    assert {(r.pos, r.batch_id) for r in found.collect()} == {(1, 0), (2, 0), (5, 1)}
    replay = spark.createDataFrame(second, "pos bigint, output string")
    incremental.dedup_batch(replay, 1, run_dir)
    again = incremental.deduplicated(spark, run_dir, "pos bigint, output string")
    assert sorted(r.pos for r in again.collect()) == [1, 2, 5]


def test_stream_resumes_where_it_stopped(spark, tmp_path):
    source, out, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "ck"))
    batches(spark, source, [[(1, "a")]])
    for expected in (1, 2):
        stream = spark.readStream.schema("pos bigint, output string").parquet(source)
        incremental.write_stream(stream, out, checkpoint).awaitTermination()
        assert spark.read.parquet(out).count() == expected
        if expected == 1:
            batches(spark, source, [[(2, "b")]])


def test_stream_through_adapter_filters_and_dedup(spark, tmp_path):
    sources = raw_tables(spark, str(tmp_path / "in"))
    mbpp = replace(sources[0], path=f"{tmp_path}/in/mbpp/train", streaming=True,
                   order_by="task_id")
    frame = jobs.decided(jobs.unified(spark, [mbpp]))
    assert frame.isStreaming
    accepted = frame.where(F.size("reasons") == 0).drop("reasons")
    incremental.dedup_stream(accepted, f"{tmp_path}/run").awaitTermination()
    kept = incremental.deduplicated(spark, f"{tmp_path}/run", accepted.schema)
    assert [(r.id, r.language) for r in kept.collect()] == [("1", "python")]
    with pytest.raises(ValueError, match="order column"):
        jobs.unified(spark, [replace(mbpp, order_by=None)])
