"""Cleaning, null handling, short-text filter, duplicates and the stable split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from textpulse.functions import clean_text, md5_bucket, word_count


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of ``columns``; any column at all by default.

    The same rows as ``dropna``, but as plain null tests: those reach the Parquet scan
    and turn an outer join below into an inner one.
    """
    wanted = set(df.columns if columns is None else columns)
    unknown = sorted(wanted - set(df.columns))
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    tests = []
    for field in df.schema.fields:
        if field.name in wanted:
            tests.append(F.col(field.name).isNotNull())
            if isinstance(field.dataType, (FloatType, DoubleType)):
                tests.append(~F.isnan(field.name))
    return df.filter(reduce(and_, tests)) if tests else df


def clean_tweets(
    df: DataFrame,
    text: str = "tweet",
    unicode: bool = False,
    required: Sequence[str] | None = None,
) -> DataFrame:
    """Drop incomplete rows and clean the text column. Text cleaned to ``""`` stays.

    Cleaning makes no nulls, so the null test can come first: at the source, and
    without a second run of the pattern.
    """
    complete = drop_incomplete(df, required)
    return complete.withColumn(text, clean_text(F.col(text), unicode))


def keep_min_words(df: DataFrame, text: str = "tweet", at_least: int = 2) -> DataFrame:
    """Keep rows whose text has at least ``at_least`` space-separated pieces."""
    return df.filter(word_count(F.col(text)) >= at_least)


def split_empty(df: DataFrame, text: str = "tweet") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): a null or empty text is rejected."""
    has_text = F.coalesce(F.length(text) > 0, F.lit(False))
    return df.filter(has_text), df.filter(~has_text)


def drop_repeated_text(df: DataFrame, text: str, order_by: str) -> DataFrame:
    """One row per distinct text, the one with the smallest ``order_by``, a unique key.

    Texts are equal when their SHA-256 digests are; null texts are one text. Only digests
    and keys are grouped: a hash aggregate that reduces copies in the map tasks, so a text
    that makes up a third of the rows reaches its reducer as one row per map task. The
    keys that are kept then pick whole rows.
    """
    rows = df.withColumn("_digest", F.coalesce(F.sha2(F.col(text), 256), F.lit("")))
    kept = rows.groupBy("_digest").agg(F.min(order_by).alias("_least"))
    same = (rows["_digest"] == kept["_digest"]) & rows[order_by].eqNullSafe(kept["_least"])
    return rows.join(kept, same, "left_semi").select(*df.columns)


def split_part(key: str, train_tenths: int = 8) -> Column:
    """``train`` or ``test`` by an md5 bucket of the key.

    Unlike ``randomSplit`` the answer does not change with the number of partitions,
    the row order or a recomputed task, and it is a plain expression: no sort.
    """
    in_train = md5_bucket(F.col(key), 10) < train_tenths
    return F.when(in_train, F.lit("train")).otherwise(F.lit("test"))


def stable_split(df: DataFrame, key: str, train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """(train, test) by ``split_part``."""
    part = split_part(key, train_tenths)
    return df.filter(part == "train"), df.filter(part == "test")


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42
) -> list[DataFrame]:
    """Spark's own split, which depends on the partitioning of its input."""
    return df.randomSplit(list(weights), seed=seed)
