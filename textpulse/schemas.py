"""Declared schemas and the names that stand for class indices."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Class index -> sentiment name, per consumer, and the name used otherwise.
STREAM_SENTIMENTS = {0: "negative", 1: "positive", 2: "neutral", 3: "irrelevant"}
STREAM_FALLBACK = "unknown"
REQUEST_SENTIMENTS = {0: "negative", 1: "positive", 2: "neutral"}
REQUEST_FALLBACK = "irrelevant"

# Part-of-speech tag prefix -> lexicon part of speech.
TAG_PREFIX_TO_POS = {"JJ": "a", "VB": "v", "NN": "n", "RB": "r"}
DEFAULT_TAG = "NN"

# Column names of the message, scored, logged and summary records.
TWEET_COLUMNS = ("id", "game", "sentiment", "tweet")
SCORED_COLUMNS = ("id", "game", "tweet", "sentiment_prediction", "prediction")
LOG_COLUMNS = ("timestamp", "tweet", "prediction", "sentiment")
SUMMARY_COLUMNS = ("Frame", "Count", "Sentiment")


def tweet_schema(id_type: DataType | None = None) -> StructType:
    """Labelled text record. The key is a 32-bit int unless a wider type is given."""
    types = {"id": id_type or IntegerType()}
    return StructType(
        [StructField(name, types.get(name, StringType()), True) for name in TWEET_COLUMNS]
    )


def labelled_text_schema() -> StructType:
    """Headered input of the enrichment flow."""
    return StructType(
        [StructField("tweet", StringType(), True), StructField("label", StringType(), True)]
    )
