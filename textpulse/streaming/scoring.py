"""Scoring a message stream and storing each micro-batch so that a repeat is harmless."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textpulse.operators.clean import drop_incomplete
from textpulse.plans.models import CLEANED, cleans
from textpulse.plans.scoring import FITTED, score
from textpulse.schemas import SCORED_COLUMNS
from textpulse.sources.messages import decode_messages

BatchWriter = Callable[[DataFrame, int], None]


def score_messages(
    messages: DataFrame,
    model: PipelineModel,
    schema: StructType | None = None,
    labelled: bool = False,
    names: str = FITTED,
) -> DataFrame:
    """Decode, score and name. Takes a table or a stream alike; keeps no state.

    A model that cleans its texts gives them as cleaned; for any other they stay as they came.
    """
    scored = score(model, drop_incomplete(decode_messages(messages, schema)), labelled, names)
    if cleans(model):
        scored = scored.withColumn("tweet", F.col(CLEANED))
    return scored.select(*SCORED_COLUMNS)


def folder_writer(path: str, echo: bool = False) -> BatchWriter:
    """Write batch N to the sub-folder ``batch_id=N``, replacing what is there.

    One folder belongs to one checkpoint: another would begin at batch 0 again and replace what is
    stored. ``streaming.committed`` has sinks that several streams can share.

    ``foreachBatch`` may run a batch again after a failure. The second run replaces
    the first, so the table holds each row once; readers see ``batch_id`` as a
    partition column.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if echo:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if echo:
            batch.show(truncate=False)
            batch.unpersist()

    return write


def start(
    stream: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Start the query. ``checkpoint`` is where a restart picks up."""
    writer = (
        stream.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def drain(stream: DataFrame, write: BatchWriter, checkpoint: str) -> None:
    """Process everything that is there, then stop. An error in the query is raised."""
    start(stream, write, checkpoint, available_now=True).awaitTermination()


def read_scored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All stored batches. ``schema`` lets an empty folder read as an empty table."""
    return spark.read.schema(schema).option("basePath", path).parquet(path)
