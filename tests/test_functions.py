from datetime import datetime

import pytest
from pyspark.ml.feature import NGram, Tokenizer
from pyspark.sql import functions as F

from textpulse.functions import (
    binary_sentiment,
    clean_text,
    is_lexical_word,
    iso_timestamp,
    lexicon_pos,
    lower_words,
    name_heads,
    ngrams,
    request_sentiment,
    stream_sentiment,
    surface_tokens,
    word_count,
)


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v")).alias("r")).first()["r"]


def test_clean_keeps_ascii_words_only(spark):
    assert one(spark, "Été_café! #Yes @bob :-)  ok…", clean_text) == "t_caf yes bob   ok"


def test_clean_unicode_keeps_letters(spark):
    got = one(spark, "Été_café! #Yes", lambda c: clean_text(c, unicode=True))
    assert got == "été_café yes"


@pytest.mark.parametrize(
    "text, words, count",
    [
        ("", [""], 1),
        (" a  b ", ["", "a", "", "b"], 5),
        ("A\tb\nC", ["a", "b", "c"], 1),
        ("   ", [], 4),
        ("x \n\t", ["x"], 2),
        ("\x0bq\f", ["", "q"], 1),
    ],
)
def test_words_equal_the_tokenizer(spark, text, words, count):
    assert one(spark, text, lower_words) == words
    assert one(spark, text, word_count) == count
    frame = spark.createDataFrame([(text,)], "v string")
    assert Tokenizer(inputCol="v", outputCol="w").transform(frame).first()["w"] == words


def test_word_count_of_null_is_null(spark):
    assert one(spark, None, word_count) is None


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_ngrams_equal_the_transformer(spark, n):
    rows = [(["a", "b", "c", "d"],), (["a", "b"],), ([],), (["", "x", ""],)]
    df = spark.createDataFrame(rows, "w array<string>").select(
        "w", ngrams(F.col("w"), n).alias("ours")
    )
    for row in NGram(n=n, inputCol="w", outputCol="theirs").transform(df).collect():
        assert row["ours"] == row["theirs"]


def test_surface_tokens(spark):
    assert one(spark, "Don't, été 42!", surface_tokens) == ["Don", "'", "t", ",", "été", "42", "!"]


@pytest.mark.parametrize("word, expected", [("run", True), ("ab", False), ("a-b", False), ("été", True)])
def test_lexical_words(spark, word, expected):
    assert one(spark, word, is_lexical_word) is expected


@pytest.mark.parametrize(
    "tag, pos", [("VBD", "v"), ("NN", "n"), ("JJR", "a"), ("RB", "r"), ("DT", None), (None, None)]
)
def test_lexicon_pos(spark, tag, pos):
    assert one(spark, tag, lexicon_pos) == pos


def test_name_heads(spark):
    assert one(spark, ["dog.n.01", "cat"], name_heads, "array<string>") == ["dog", "cat"]


@pytest.mark.parametrize(
    "index, stream, served",
    [
        (0.0, "negative", "negative"),
        (1.0, "positive", "positive"),
        (2.0, "neutral", "neutral"),
        (3.0, "irrelevant", "irrelevant"),
        (4.0, "unknown", "irrelevant"),
        (None, "unknown", "irrelevant"),
    ],
)
def test_class_names(spark, index, stream, served):
    assert one(spark, index, stream_sentiment, "double") == stream
    assert one(spark, index, request_sentiment, "double") == served


@pytest.mark.parametrize(
    "score, name", [(0.5, "negative"), (0.51, "positive"), (0.0, "negative"), (None, None)]
)
def test_binary_names(spark, score, name):
    assert one(spark, score, binary_sentiment, "double") == name


def test_iso_timestamp(spark):
    moment = datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, moment, iso_timestamp, "timestamp_ntz") == "2024-01-02T03:04:05.000000"
