"""Looking rows up in a table that has one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse.session import ready_checkpoints

_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; -1 turns broadcasts off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    digits = text.rstrip("bkmgt")
    unit = text[len(digits):][:1] or "b"
    return int(digits) * _UNITS[unit]


def measured_bytes(df: DataFrame) -> int:
    """Size of a table as JSON text, counted on the executors."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    return df.agg(F.coalesce(size, F.lit(0))).first()[0]


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    max_bytes: int | None = None,
) -> DataFrame:
    """Join ``rows`` to a ``table`` that has one row per key; keys are not null.

    The table is stored first, so that it is worked out once and its size is known.
    It is broadcast only when that size is within the session's broadcast limit.
    Otherwise both sides shuffle, with hot keys split: see ``salted_join``.
    ``spread_by`` names columns of ``rows`` that tell apart the rows of one key.
    """
    ready_checkpoints(rows.sparkSession)
    table = table.checkpoint()
    limit = broadcast_limit(rows.sparkSession) if max_bytes is None else max_bytes
    if limit > 0 and measured_bytes(table) <= limit:
        return rows.join(F.broadcast(table), list(on), how)
    return salted_join(rows, table, on, spread_by, how)


def salted_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Shuffle join in which every key with more than an average partition is split.

    Keys are counted once. A key with c of the N rows, over P shuffle partitions,
    gets ceil(c * P / N) salts when c > N / P. At most P keys can pass that test and
    their salts add up to at most 2 * P: that bounds both the broadcast list of hot
    keys and the extra copies of table rows, whatever the data.
    """
    on = list(on)
    spark = rows.sparkSession
    ready_checkpoints(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(*on).agg(F.count("*").alias("_n")).checkpoint()
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    average = max(total / partitions, 1.0)
    hot = counts.filter(F.col("_n") > average).select(
        *on, F.ceil(F.col("_n") / F.lit(average)).cast("int").alias("_salts")
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    left = (
        rows.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts).cast("int"))
        .drop("_salts")
    )
    right = (
        table.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return left.join(right, [*on, "_salt"], how).drop("_salt")
