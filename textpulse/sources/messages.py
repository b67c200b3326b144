"""JSON messages: encoding rows, decoding a bytes value, and the stream endpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textpulse.schemas import tweet_schema

_CORRUPT = "_corrupt"


def encode_messages(
    df: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One JSON text per row in ``value``, beside the columns to ``keep``. Null fields are left out."""
    fields = [F.col(c) for c in (columns or df.columns)]
    return df.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def decode_messages(
    df: DataFrame, schema: StructType | None = None, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Flat columns from the JSON in ``value`` (bytes or text), beside the columns to ``keep``.

    A message that is null or not JSON gives a row of nulls, a field of the wrong type
    gives a null, and keys that the schema does not name are ignored.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema or tweet_schema())
    # ``inline`` flattens the struct; unlike ``v.*`` it keeps later filters from
    # parsing every message a second time.
    return df.select(*keep, F.inline(F.array(parsed)))


def split_corrupt(
    df: DataFrame, schema: StructType | None = None, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, messages that could not be read whole, as text)."""
    wanted = schema or tweet_schema()
    text = F.col(value).cast("string")
    with_corrupt = StructType([*wanted.fields, StructField(_CORRUPT, StringType(), True)])
    parsed = F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT})
    rows = df.select(text.alias("_text"), F.inline(F.array(parsed)))
    bad = F.col("_text").isNull() | F.col(_CORRUPT).isNotNull()
    good = rows.filter(~bad).select(*wanted.names)
    return good, rows.filter(bad).select(F.col("_text").alias(value))


def kafka_options(
    servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None
) -> dict[str, str]:
    """Options of Spark's ``kafka`` stream source."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A message stream from Kafka; needs Spark's Kafka package on the class path."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.selectExpr("CAST(value AS STRING) AS value")


def file_stream(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same message stream read from JSON-lines files as they appear in a folder."""
    reader = spark.readStream.format("text").option("wholetext", False)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)
