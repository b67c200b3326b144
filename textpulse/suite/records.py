"""Messages, served records, logs, and files written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from textpulse.functions import request_sentiment
from textpulse.operators.clean import drop_incomplete
from textpulse.schemas import labelled_text_schema, tweet_schema
from textpulse.session import new_folder
from textpulse.sources import messages, readers, writers
from textpulse.sources.quoted_csv import read_quoted_csv
from textpulse.sources.readers import read_table
from textpulse.suite.inputs import RATED_SQL, rated_tweets, tweets
from textpulse.suite.registry import query


def event_log(spark, sf):
    """Events as logged results: even ones carry a name, odd ones a stream name."""
    even = F.col("event_id") % 2 == 0
    return read_table(spark, sf, "events").select(
        F.col("event_id").alias("_id"),
        F.col("ts").alias("timestamp"),
        F.col("props").alias("tweet"),
        F.col("value").alias("prediction"),
        F.when(even, F.col("event_type")).alias("sentiment"),
        F.when(~even, F.col("event_type")).alias("sentiment_prediction"),
    )


SERVED_SQL = """SELECT event_id::VARCHAR AS _id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
  props AS tweet, value AS prediction, event_type AS sentiment FROM events"""


@query("normalise_record", SERVED_SQL)
def normalise_record(spark, sf):
    return readers.serve_records(event_log(spark, sf))


@query("read_predictions", f"{SERVED_SQL} ORDER BY event_id LIMIT 10")
def read_predictions(spark, sf):
    first = readers.first_records(event_log(spark, sf), ["_id"], rows=10)
    return readers.serve_records(first)


@query(
    "read_all",
    """SELECT event_id AS _id, ts AS timestamp, props AS tweet, value AS prediction,
      event_type AS sentiment FROM events""",
)
def read_all(spark, sf):
    log = event_log(spark, sf)
    sentiment = F.coalesce("sentiment", "sentiment_prediction").alias("sentiment")
    return log.select("_id", "timestamp", "tweet", "prediction", sentiment)


@query(
    "parse_messages",
    "SELECT event_id, (props::JSON->>'k')::BIGINT AS k FROM events",
)
def parse_messages(spark, sf):
    """Event properties as message bytes, decoded next to their key."""
    schema = StructType([StructField("k", LongType(), True)])
    value = F.from_json(F.col("props").cast("binary").cast("string"), schema)
    return (
        read_table(spark, sf, "events")
        .select("event_id", value.alias("v"))
        .select("event_id", "v.*")
    )


@query(
    "replay_json",
    f"""WITH {RATED_SQL} SELECT id, game, sentiment, text AS tweet FROM rated
    WHERE id IS NOT NULL AND game IS NOT NULL AND sentiment IS NOT NULL AND text IS NOT NULL""",
)
def replay_json(spark, sf):
    """Rows to messages and back; a null field makes the message incomplete."""
    sent = messages.encode_messages(rated_tweets(spark, sf))
    return drop_incomplete(messages.decode_messages(sent, tweet_schema(LongType())))


@query(
    "csv_round_trip",
    "SELECT doc_id AS id, source AS game, lang AS sentiment, text AS tweet FROM documents",
)
def csv_round_trip(spark, sf):
    """Whole texts, newlines and quotes included, through the headerless CSV reader."""
    path = new_folder(spark, "tweets-csv")
    writers.write_csv(tweets(spark, sf), path, header=False)
    return readers.read_tweet_csv(spark, path, tweet_schema(LongType()))


@query(
    "labelled_csv_round_trip",
    "SELECT text AS tweet, role AS label FROM conversations",
)
def labelled_csv_round_trip(spark, sf):
    """Texts and labels through the headered CSV reader of the enrichment flow."""
    path = new_folder(spark, "labelled-csv")
    turns = read_table(spark, sf, "conversations").select(
        F.col("text").alias("tweet"), F.col("role").alias("label")
    )
    writers.write_csv(turns, path, header=True)
    return readers.read_labelled_csv(spark, path)


@query(
    "csv_by_blocks",
    "SELECT doc_id AS id, source AS game, lang AS sentiment, text AS tweet FROM documents",
)
def csv_by_blocks(spark, sf):
    """Whole texts through the reader that cuts files into blocks, newlines in quotes or not."""
    path = new_folder(spark, "tweets-csv")
    writers.write_csv(tweets(spark, sf), path, header=False)
    return read_quoted_csv(spark, path, tweet_schema(LongType()))


@query(
    "labelled_csv_by_blocks",
    "SELECT text AS tweet, lang AS label FROM documents",
)
def labelled_csv_by_blocks(spark, sf):
    """The same with a header in every file."""
    path = new_folder(spark, "labelled-csv")
    rows = tweets(spark, sf).select("tweet", F.col("sentiment").alias("label"))
    writers.write_csv(rows, path, header=True)
    return read_quoted_csv(spark, path, labelled_text_schema(), header=True)


def written_log(spark, sf):
    """Conversation turns logged with the class of their turn number and the time."""
    path = new_folder(spark, "scored-log")
    scored = read_table(spark, sf, "conversations").select(
        F.col("text").alias("tweet"), F.col("turn").cast("double").alias("prediction")
    )
    scored = scored.withColumn("sentiment", request_sentiment(F.col("prediction")))
    writers.append_log(writers.scored_log(scored), path)
    return spark.read.parquet(path)


@query(
    "scored_log",
    """SELECT true AS has_time, text AS tweet, turn::DOUBLE AS prediction,
      CASE turn WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' WHEN 2 THEN 'neutral'
      ELSE 'irrelevant' END AS sentiment FROM conversations""",
)
def scored_log(spark, sf):
    """The log, its time reduced to whether it is there and is not in the future."""
    has_time = F.col("timestamp") <= F.current_timestamp()
    rows = written_log(spark, sf).withColumn("has_time", F.coalesce(has_time, F.lit(False)))
    return rows.drop("timestamp")


@query(
    "log_round_trip",
    """SELECT text AS tweet, turn::DOUBLE AS prediction,
      CASE turn WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' WHEN 2 THEN 'neutral'
      ELSE 'irrelevant' END AS sentiment FROM conversations""",
)
def log_round_trip(spark, sf):
    """The scored log without its time of writing."""
    return written_log(spark, sf).drop("timestamp")
