"""Input frames of the registered queries, in Spark and in SQL.

The given tables hold clean prose. So that every rule has something to find, each
row gets a variant picked by its id: raw language and license spellings, text
around the document, code before it. All rows and whole texts take part.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.catalog import sql
from siftloom.functions.rows import settled
from siftloom.operators.unify import assert_tests

LANGUAGES = ("Python3", " JS ", "golang", "klingon", "", "C++", "ruby", "N/A")
LICENSES = ("MIT License", "Apache2", "gpl-3.0", " MIT ", "", "bsd3", "CC-BY-4.0")
DIFFICULTIES = ("Easy", "medium ", "HARD", "brutal", "")
PREFIXES = ("", "", " \t", "", "\r\n", "\u3000")
SUFFIXES = ("", "  \r\n\r\n\r\nend\x1f", "\n// Code generated by a tool", "\x0b\n\x0c", "\x07bell",
            "\r", "", " \t \n \n\n\nlast \u00a0", "\n@Generated", "\u2028x\x85y", "", "\x00",
            "\n\nplain")
# ids of rows added to the documents start here
EXTRA = 1_000_000_000
REPEATED = "same line" + "\n same line \nsame line" * 29 + "\n same line \n"
SNIPPETS = ("def hello():\n    print(1)\n", "function f() { console.log('x'); }\n",
            "#!/usr/bin/env fish\n", "#!/usr/bin/python3\n",
            "#include <stdio.h>\nint main() {}\n", "public  class Main { }\n",
            "<?php echo $x;\n", "package main\nimport (\"fmt\")\nfunc main() {}\n",
            "SELECT a\nFROM b\n", ".box  { color: red }\n", "", "#!/bin/sh\n", "fun  go (x)\n",
            "class A: pass # file.ts\n")
FILE_NAMES = ("", "a.m", "a.scala.html", "main.rs", "README", "b.h", "x.F90", "lib.TSX", "a.b")
HINTS = ("", "Perl", "klingon", " zig ")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _variant(key: Column, text: Column) -> Column:
    body = (F.when(key % 13 == 5, F.replace(text, F.lit("\n"), F.lit(" ")))
            .when(key % 29 == 7, F.concat(text, F.lit("\n" + REPEATED))).otherwise(text))
    return F.concat(pick(PREFIXES, key % len(PREFIXES)), body,
                    pick(SUFFIXES, key % len(SUFFIXES)))


def given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, and besides them rows without a text for the rules about empty ones."""
    df = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    blank = df.where(F.col("doc_id") % 31 == 9).withColumns(
        {"doc_id": F.col("doc_id") + EXTRA, "text": F.lit(" \n")})
    return df.unionByName(blank)


GIVEN = f"""given AS (
SELECT doc_id, text, lang, source FROM documents UNION ALL
SELECT doc_id + {EXTRA}, ' ' || chr(10), lang, source FROM documents WHERE doc_id % 31 = 9)"""


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with uneven text: (pos, text)."""
    df = given(spark, sf_dir)
    return settled(df.select(F.col("doc_id").alias("pos"),
                             _variant(F.col("doc_id"), F.col("text")).alias("text")), "text")


RAW_DOCUMENTS = f"""{GIVEN}, raw_documents AS MATERIALIZED (
SELECT doc_id AS pos,
  {sql.pick(PREFIXES, f"doc_id % {len(PREFIXES)}")} ||
  CASE WHEN doc_id % 13 = 5 THEN replace(text, chr(10), ' ')
       WHEN doc_id % 29 = 7 THEN text || chr(10) || {sql.quote("same line")} || repeat(chr(10) || ' same line ' || chr(10) || 'same line', 29) || chr(10) || ' same line ' || chr(10) ELSE text END ||
  {sql.pick(SUFFIXES, f"doc_id % {len(SUFFIXES)}")} AS text
FROM given)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as uncleaned samples, with spellings and blanks for the rules to find."""
    df, key = given(spark, sf_dir), F.col("doc_id")
    return df.select(
        key.alias("pos"), key.cast("string").alias("id"), F.col("source").alias("dataset"),
        pick(LANGUAGES, key % len(LANGUAGES)).alias("language"),
        pick(LICENSES, key % len(LICENSES)).alias("license"),
        F.when(key % 17 == 3, F.lit(" \n"))
        .otherwise(F.concat(F.lit("Continue the text of "), "source", F.lit(".")))
        .alias("instruction"),
        F.when(key % 4 == 0, F.concat(F.lit(" Language: "), "lang")).otherwise(F.lit(""))
        .alias("input"),
        _variant(key, F.col("text")).alias("output"),
        assert_tests(F.when(key % 3 == 0, F.array(F.lit("assert f()")))).alias("tests"),
        pick(DIFFICULTIES, key % len(DIFFICULTIES)).alias("difficulty"),
        F.create_map(F.lit("lang"), F.col("lang")).alias("metadata"))


SAMPLES = f"""{RAW_DOCUMENTS}, samples AS MATERIALIZED (
SELECT pos, CAST(pos AS VARCHAR) AS id, source AS dataset,
  {sql.pick(LANGUAGES, f"pos % {len(LANGUAGES)}")} AS language,
  {sql.pick(LICENSES, f"pos % {len(LICENSES)}")} AS license,
  CASE WHEN pos % 17 = 3 THEN ' ' || chr(10) ELSE 'Continue the text of ' || source || '.' END AS instruction,
  CASE WHEN pos % 4 = 0 THEN ' Language: ' || lang ELSE '' END AS input,
  r.text AS output, CASE WHEN pos % 3 = 0 THEN 1 ELSE 0 END AS n_tests,
  {sql.pick(DIFFICULTIES, f"pos % {len(DIFFICULTIES)}")} AS difficulty
FROM given d JOIN raw_documents r ON d.doc_id = r.pos)"""

def named(source: str) -> str:
    """CTEs `named` and `counted`: cleaned and normalized samples, with token counts."""
    return f"""named AS MATERIALIZED (
SELECT * REPLACE ({sql.filter_language("language")} AS language,
  {sql.normalize_license("license")} AS license, {sql.clean("instruction")} AS instruction,
  {sql.clean("input")} AS input, {sql.clean("output")} AS output)
FROM {source}), counted AS MATERIALIZED (
SELECT *, {sql.tokens("instruction")} + {sql.tokens("input")} + {sql.tokens("output")} AS token_count
FROM named)"""


NAMED = f"{SAMPLES}, {named('samples')}"


def coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with a line of code in front, a file name and a hint."""
    df, key = table(spark, sf_dir, "documents"), F.col("doc_id")
    return df.select(
        key.alias("pos"), "source",
        F.concat(pick(SNIPPETS, key % len(SNIPPETS)), "text").alias("code"),
        pick(FILE_NAMES, key % len(FILE_NAMES)).alias("filename"),
        pick(HINTS, key % len(HINTS)).alias("hint"))


CODED = f"""coded AS MATERIALIZED (
SELECT doc_id AS pos, source, {sql.pick(SNIPPETS, f"doc_id % {len(SNIPPETS)}")} || text AS code,
  {sql.pick(FILE_NAMES, f"doc_id % {len(FILE_NAMES)}")} AS filename,
  {sql.pick(HINTS, f"doc_id % {len(HINTS)}")} AS hint FROM documents)"""


def file_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages with a file name at the end of the address."""
    df, key = table(spark, sf_dir, "pages"), F.col("page_id")
    return df.select(key.alias("pos"), F.concat(
        "url", F.lit("/"), pick(FILE_NAMES, key % len(FILE_NAMES))).alias("filename"), "html")


FILE_URL = f"""file_url AS MATERIALIZED (
SELECT page_id AS pos, url || '/' || {sql.pick(FILE_NAMES, f"page_id % {len(FILE_NAMES)}")} AS filename,
  html FROM pages)"""
