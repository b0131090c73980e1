import random
import re

import pytest
from pyspark.sql import functions as F

from windrow import constants as c
from windrow.functions.text import java_split, whitespace_pieces
from windrow.operators.tokens import line_words, whitespace_words

SPLITS = {
    "A  b ": ["A", "", "b"],
    "": [""],
    " ": [],
    " lead": ["", "lead"],
    "a\t b  \t": ["a", "", "b"],
    "one": ["one"],
    " \n\t ": [],
    "a\x0bb\fc\rd": ["a", "b", "c", "d"],
    "no break": ["no break"],
}


def _pieces(spark, values, column):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return {row.value: row.pieces for row in df.select("value", column.alias("pieces")).collect()}


def test_whitespace_pieces(spark):
    assert _pieces(spark, SPLITS, whitespace_pieces(F.col("value"))) == SPLITS


def test_java_split_agrees_on_whitespace(spark):
    assert _pieces(spark, SPLITS, java_split(F.col("value"), c.WHITESPACE)) == SPLITS


@pytest.mark.parametrize(
    "text, pattern, pieces",
    [
        ("a,b,,", ",", ["a", "b"]),
        (",a", ",", ["", "a"]),
        (",,", ",", []),
        ("abc", ",", ["abc"]),
        ("", ",", [""]),
        ("boo:and:foo", "o", ["b", "", ":and:f"]),
    ],
)
def test_java_split(spark, text, pattern, pieces):
    assert _pieces(spark, [text], java_split(F.col("value"), pattern)) == {text: pieces}


def test_long_runs_of_blanks_are_cut_in_linear_time(spark):
    text = "a" + " " * 200_000 + "b" + " " * 200_000
    pieces = _pieces(spark, [text], whitespace_pieces(F.col("value")))[text]
    assert len(pieces) == 200_001 and pieces[0] == "a" and pieces[-1] == "b"


def test_null_text_gives_no_words(spark):
    df = spark.createDataFrame([(None,), ("x y",)], "value string")
    assert [r.word for r in whitespace_words(df).collect()] == ["x", "y"]
    assert [r.word for r in line_words(df).collect()] == ["x y"]


def test_words_keep_other_columns_and_case(spark):
    df = spark.createDataFrame([(7, "A  a ")], "n int, value string")
    assert sorted(map(tuple, whitespace_words(df).collect())) == [(7, ""), (7, "A"), (7, "a")]


def test_line_words_default_pattern_never_matches_lowered_text(spark):
    df = spark.createDataFrame([(r"x\NNy",), ("",), ("Two Words",)], "value string")
    assert sorted(r.word for r in line_words(df).collect()) == ["two words", r"x\nny"]


def test_line_words_by_non_word(spark):
    df = spark.createDataFrame([("Hello, WORLD! x_1",)], "value string")
    assert [r.word for r in line_words(df, pattern=c.NON_WORD).collect()] == ["hello", "world", "x_1"]


def _split_like_java(text, pattern):
    pieces = re.split(pattern, text)
    if len(pieces) == 1:
        return pieces
    while pieces and not pieces[-1]:
        pieces.pop()
    return pieces


@pytest.mark.parametrize("pattern", [r"\s", ",", "[ab]", r"\\N+"])
def test_random_texts(spark, pattern):
    rng = random.Random(3)
    texts = {"".join(rng.choice(" \t\nab,\\N") for _ in range(rng.randrange(12))) for _ in range(400)}
    expected = {text: _split_like_java(text, pattern) for text in texts}
    assert _pieces(spark, texts, java_split(F.col("value"), pattern)) == expected
    if pattern == c.WHITESPACE:
        assert _pieces(spark, texts, whitespace_pieces(F.col("value"))) == expected
