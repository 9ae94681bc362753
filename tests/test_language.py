import random
import re

from pyspark.sql import functions as F

from siftloom import constants as C
from siftloom.functions import language as L
from siftloom.functions.licenses import normalize_license
from siftloom.operators.unify import normalize_difficulty


def detect(spark, codes, filename=None, hint=None):
    df = spark.createDataFrame(list(enumerate(codes)), "i int, code string")
    found = L.with_language(df, "code", "language",
                            F.lit(filename) if filename else None, F.lit(hint) if hint else None)
    return [r.language for r in found.orderBy("i").collect()]


def test_given_examples(spark):
    assert detect(spark, ["def hello():\n    print('world')",
                          "function hello() { console.log('world'); }"]) == ["python", "javascript"]


def test_order_of_evidence(spark):
    assert detect(spark, ["#!/usr/bin/env fish", "x"], "a.rs") == ["bash", "rust"]
    assert detect(spark, ["def f(): pass", "def f(): return 12345"], hint=" Zig ") == [
        "zig", "python"]
    assert detect(spark, ["", "12 34"], hint="klingon") == ["unknown", "unknown"]


def test_extensions(column):
    names = ["file.py", "file.js", "file.java", "a.m", "a.scala.html", "a.h", "README", "A.CPP",
             "x.unknown", ""]
    assert column(L.from_extension, names) == [
        "python", "javascript", "java", "matlab", "html", "c", None, "cpp", None, None]


def test_shebangs(column):
    codes = ["#!/usr/bin/env python3\nx", "#!/usr/bin/env node", "#!/usr/bin/env fish",
             "#!/usr/bin/ruby", "#!/usr/bin/perl", "#!/bin/awk", "x\n#!/bin/sh"]
    assert column(L.from_shebang, codes) == [
        "python", "javascript", "bash", "ruby", "perl", None, None]


def test_keyword_scores_match_a_plain_count(spark):
    pieces = [k for _, keywords, _ in C.LANGUAGE_EVIDENCE for k in keywords] + [
        "public  class X", "FN go(", "$é", ".a-b {", "#x\n{", "select a", "  insert into t",
        "import (", "using\tSystem", "#include <a.h>", "typeſcript", ".ts", ".tsx", ".ts\n", "\n",
        "import Foundation", "@interface  Z", "fun é (", "<?PHP", "K", "\x1cSELECT 1"]
    rng = random.Random(3)
    codes = [" ".join(rng.choices(pieces, k=rng.randint(0, 4))) for _ in range(1500)] + pieces

    def plain(code):
        low = code.lower()
        scores = {
            language: 2 * sum(k in low for k in keywords)
            + 3 * sum(bool(re.search(p, code, re.M | re.I)) for p in patterns)
            for language, keywords, patterns in C.LANGUAGE_EVIDENCE}
        top = max(scores.values())
        return next(name for name, s in scores.items() if s == top) if top else None

    df = (spark.createDataFrame(list(enumerate(codes)), "i int, code string")
          .withColumns({"lo": F.lower("code"), "fo": L.folded(F.col("code"))}))
    found = df.select("i", L.from_keywords("code", "lo", "fo").alias("r")).orderBy("i").collect()
    assert [r.r for r in found] == [plain(c) for c in codes]


def test_names(column):
    assert column(L.normalize_language, ["python", "PY", "c++", "unknown_lang", None, ""]) == [
        "python", "python", "cpp", "unknown", "unknown", "unknown"]
    assert column(L.filter_language_name, ["Python3", " JS ", "golang", "klingon", "", None]) == [
        "python", "javascript", "go", "klingon", "", ""]
    assert column(normalize_license, ["MIT License", "Apache2", "gpl-3.0", "", None]) == [
        "mit", "apache-2.0", "gpl-3.0", "", ""]
    assert column(normalize_difficulty, ["Easy", " HARD ", "brutal", None]) == [
        "easy", "hard", "unknown", "unknown"]
