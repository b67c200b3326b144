"""Replaying a labelled table as a message stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textpulse.schemas import TWEET_COLUMNS
from textpulse.sources.messages import encode_messages, file_stream


def write_replay(df: DataFrame, folder: str, files: int | None = None) -> None:
    """Write rows as JSON-lines message files; the file count sets the batch count."""
    messages = encode_messages(df, TWEET_COLUMNS)
    if files:
        messages = messages.repartition(files)
    messages.write.mode("errorifexists").text(folder)


def replay_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """Read the message files back a few at a time, one group per trigger."""
    return file_stream(spark, folder, files_per_trigger)


def send_to_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Publish every row as one message, in parallel, through Spark's Kafka sink."""
    (
        encode_messages(df, TWEET_COLUMNS)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
