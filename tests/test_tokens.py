"""Contraction-aware tokens: literal cases, and one form in both engines."""

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textpulse.functions import contraction_tokens
from textpulse.functions.tokens import contraction_tokens_sql
from textpulse.plans.semantics import word_tokens

CASES = {
    "I don't know.": "I do n't know .",
    "They'll can't won't DON'T": "They 'll ca n't wo n't DO N'T",
    "cannot Gonna, (gotta)": "can not Gon na , ( got ta )",
    "John's dogs' bones": "John 's dogs ' bones",
    "it's... wait… what....": "it 's ... wait … what ....",
    'He said "hello there" ("x").': "He said `` hello there '' ( `` x '' ) .",
    "“Quoted” text, 3,000 at 10:30: yes": "`` Quoted '' text , 3,000 at 10:30 : yes",
    "J. K. Rowling wrote it. Next.": "J. K. Rowling wrote it . Next .",
    "'single quoted' words": "` single quoted ' words",
    "a--b; c@d 50% & <b>": "a -- b ; c @ d 50 % & < b >",
    "I've you're we'd I'm he'S don’t": "I 've you 're we 'd I 'm he 'S do n't",
    "rock'n'roll o'clock": "rock'n'roll o'clock",
    "": "", " \t\n ": "", "x": "x",
}


def test_literal_cases(spark):
    df = spark.createDataFrame(list(CASES.items()), "text string, expected string")
    for r in df.withColumn("got", contraction_tokens(F.col("text"))).collect():
        assert r["got"] == r["expected"].split(), r["text"]


def test_null_has_no_tokens(spark):
    df = spark.createDataFrame([(1, None), (2, "it's")], "k int, t string")
    assert [tuple(r) for r in word_tokens(df, ["k"], "t", contractions=True).collect()] == [(2, 0, "it"), (2, 1, "'s")]
    assert word_tokens(df, ["k"], "t").count() == 3


@pytest.fixture(scope="module")
def duck():
    return duckdb.connect()


PIECES = ["a", "don't", "can", "not", "'", "’", "“", '"', ".", "..", " ", "\n", "\x0b", "é", "S", "'ll", ",", "1", "--", "(", "]", "日", "…", "\x85"]


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=20, max_size=20))
def test_both_engines_agree(spark, duck, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    ours = [r[0] for r in df.orderBy("i").select(contraction_tokens(F.col("t"))).collect()]
    for text, tokens in zip(texts, ours):
        assert duck.execute(f"SELECT {contraction_tokens_sql('$t')}", {"t": text}).fetchone()[0] == tokens


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=20, max_size=20))
def test_no_character_is_lost(spark, texts):
    """But for white space and the form of quotes, tokens hold the text."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.withColumn("got", contraction_tokens(F.col("t"))).collect():
        def plain(text):
            text = "".join(text.split()) if isinstance(text, str) else "".join(text)
            for mark in ("``", "''", "“", "”", '"', "‘", "’", "`", "'", "\x85"):
                text = text.replace(mark, "")
            return text

        assert plain(r["got"]) == plain(r["t"])
