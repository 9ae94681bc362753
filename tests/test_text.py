import random
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftloom.functions import text as X
from siftloom.functions import tokens as K

ALPHABET = "ab \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0    　é漢\U0001f600\n\n"


def python_clean(t):
    t = t.replace("\r\n", "\n").replace("\r", "\n")
    t = "\n".join(line.rstrip() for line in t.split("\n"))
    return re.sub("\n{3,}", "\n\n", t).strip()


def random_texts(n=4000):
    rng = random.Random(7)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(n)]


def test_character_sets_are_pythons():
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    assert set(X.WHITESPACE) == {c for c in every if c.isspace()}
    assert set(X.LINE_ENDS) == {c for c in every if len(f"a{c}b".splitlines()) > 1}


def test_string_rules_match_python(column):
    texts = random_texts()
    assert column(X.strip, texts) == [t.strip() for t in texts]
    assert column(X.clean_text, texts) == [python_clean(t) for t in texts]
    assert column(X.split_lines, texts) == [t.splitlines() for t in texts]
    assert column(X.words, texts) == [t.split() for t in texts]
    assert column(X.stripped_lines, texts) == [
        [s.strip() for s in t.splitlines() if s.strip()] for t in texts]
    assert column(X.remove_trailing_spaces, texts) == [
        "\n".join(s.rstrip() for s in t.split("\n")) for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), min_size=1))
def test_clean_text_on_any_unicode(column, texts):
    assert column(X.clean_text, texts) == [python_clean(t) for t in texts]


def test_clean_text_examples(column):
    assert column(X.clean_text, ["a \r\nb\t\r\r\r\rc\x1f", None, ""]) == ["a\nb\n\nc", "", ""]


def test_long_blank_runs_stay_linear(column):
    blank = "a" + " " * 300_000 + "b" + "　" * 300_000
    assert column(X.clean_text, [blank]) == [python_clean(blank)]
    assert len(column(X.stripped_lines, [blank])[0]) == 1


def test_invalid_bytes_are_dropped(spark):
    df = spark.createDataFrame([(bytearray(b"ok\xffgo"),)], "b binary")
    assert df.select(X.clean_text(F.col("b").cast("string"))).first()[0] == "okgo"


def test_collapse_maximum(column):
    assert column(lambda c: X.collapse_blank_lines(c, 1), ["a\n\n\nb\nc"]) == ["a\nb\nc"]


def test_token_counts(column):
    pattern = re.compile(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\x0b\f\r]")
    texts = random_texts(500) + ["x = foo(1, 'é')", "a_b-c", "\U0001f600\U0001f600"]
    assert column(K.count_tokens, texts) == [len(pattern.findall(t)) for t in texts]
    assert column(lambda c: K.truncate(c, 3), ["  a  b\n(c) d", "one"]) == ["  a  b\n(", "one"]


def test_within_limit(spark):
    df = spark.createDataFrame([("a b", "", "c"), ("a b", "x", "c")],
                               "instruction string, input string, output string")
    assert [r[0] for r in df.select(K.within_limit(3)).collect()] == [True, False]
    doubled = df.select(K.sample_tokens(lambda c: F.length(c)))
    assert [r[0] for r in doubled.collect()] == [4, 5]


def test_own_replacement_characters_stay(spark):
    df = spark.createDataFrame([(bytearray("a\ufffdb".encode() + b"\xff" + "c\ufdd1".encode()),)],
                               "v binary")
    fixed = df.select(X.remove_invalid_utf(F.col("v").cast("string")).alias("t")).first().t
    assert fixed == "a\ufffdbc\ufdd1"
