"""Stream queries: files of messages drained through the streaming code."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from textpulse.operators.clean import clean_tweets
from textpulse.operators.partitions import spread_rows
from textpulse.plans import models
from textpulse.plans.training import fit_classifier
from textpulse.schemas import SCORED_COLUMNS, TWEET_COLUMNS, tweet_schema
from textpulse.session import new_folder
from textpulse.sources.messages import decode_messages, encode_messages
from textpulse.sources.replay_log import EARLIEST, LATEST, SCHEMA, append_log, read_log_stream
from textpulse.streaming import replay, scoring
from textpulse.streaming.committed import committed_writer, positioned_writer, read_committed
from textpulse.suite.inputs import CLEAN_SQL, RATED_SQL, bucket_sql, rated_tweets, tweets
from textpulse.suite.models import CLEANED_NB_SQL, split_tweets
from textpulse.suite.registry import query


def drained(spark, stream, schema):
    """Everything a stream has to give, through the committed sink."""
    out, checkpoint = new_folder(spark, "scored"), new_folder(spark, "stream-checkpoint")
    scoring.drain(stream, committed_writer(out), checkpoint)
    return read_committed(spark, out, schema)


def replayed(spark, rows):
    """The rows as a message stream that gives every task slot one file per batch."""
    folder = new_folder(spark, "messages")
    replay.write_replay(rows, folder)
    return replay.replay_stream(spark, folder, spark.sparkContext.defaultParallelism)


@query(
    "stream_clean",
    f"""WITH {RATED_SQL} SELECT id, game, sentiment, {CLEAN_SQL} AS tweet FROM rated
    WHERE id IS NOT NULL AND game IS NOT NULL AND sentiment IS NOT NULL AND text IS NOT NULL""",
)
def stream_clean(spark, sf):
    """Messages decoded and cleaned in micro-batches; incomplete ones drop."""
    schema = tweet_schema(LongType())
    stream = replayed(spark, rated_tweets(spark, sf, waves=2))
    cleaned = clean_tweets(decode_messages(stream, schema))
    return drained(spark, cleaned, schema).select(*schema.names)


@query(
    "stream_score",
    f"""WITH {CLEANED_NB_SQL} SELECT id, game, cleaned AS tweet,
      name AS sentiment_prediction, prediction FROM scored""",
)
def stream_score(spark, sf):
    """All texts as messages, scored in micro-batches by a model that cleans them."""
    schema = tweet_schema(LongType())
    train, _ = split_tweets(spark, sf)
    model = fit_classifier(models.nb_vocabulary(clean=True), train)
    stream = replayed(spark, spread_rows(tweets(spark, sf), "id", waves=2))
    scored = scoring.score_messages(stream, model, schema)
    return drained(spark, scored, scored.schema).select(*SCORED_COLUMNS)


#: Partitions of the message log of the query below.
LOG_PARTITIONS = 8


@query(
    "stream_offsets",
    f"""WITH keyed AS (
      SELECT doc_id AS id, text AS tweet, lpad(doc_id::VARCHAR, 20, '0') AS key, doc_id % 2 = 1 AS after_start
      FROM documents),
    placed AS (SELECT *, {bucket_sql("key", LOG_PARTITIONS)}::INT AS partition FROM keyed)
    SELECT partition, row_number() OVER (PARTITION BY partition ORDER BY after_start, key) - 1 AS "offset",
           id, tweet, after_start FROM placed""",
)
def stream_offsets(spark, sf):
    """All texts as a message log of two appends, read by two queries that restart in between: all
    messages with their offsets, and whether they came after the query that began at the latest ones."""
    rows = tweets(spark, sf).withColumn("key", F.lpad(F.col("id").cast("string"), 20, "0"))
    messages = encode_messages(rows, TWEET_COLUMNS, keep=["id", "key"])
    path = new_folder(spark, "log")
    sinks = {start: new_folder(spark, "messages") for start in (EARLIEST, LATEST)}
    checkpoints = {start: new_folder(spark, "stream-checkpoint") for start in sinks}
    for half in (0, 1):
        append_log(messages.filter(F.col("id") % 2 == half), path, LOG_PARTITIONS)
        for start, sink in sinks.items():
            stream = read_log_stream(spark, path, start)
            scoring.drain(stream, positioned_writer(sink, "log"), checkpoints[start])
    every, late = (read_committed(spark, sink, SCHEMA) for sink in sinks.values())
    late = late.select("partition", "offset", F.lit(True).alias("late"))
    marked = every.join(late, ["partition", "offset"], "left")
    marked = marked.withColumn("after_start", F.coalesce("late", F.lit(False)))
    decoded = decode_messages(marked, tweet_schema(LongType()), keep=["partition", "offset", "after_start"])
    return decoded.select("partition", "offset", "id", "tweet", "after_start")
