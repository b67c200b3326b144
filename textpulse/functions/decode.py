"""Turning class indices, scores and times into the values that are served."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from textpulse.schemas import (
    REQUEST_FALLBACK,
    REQUEST_SENTIMENTS,
    STREAM_FALLBACK,
    STREAM_SENTIMENTS,
)


def decode_class(prediction: Column, names: dict[int, str], fallback: str) -> Column:
    """Look a class index up in ``names``; anything else, null included, is ``fallback``."""
    table = F.create_map(
        *chain(*[(F.lit(float(index)), F.lit(name)) for index, name in names.items()])
    )
    index = F.coalesce(prediction.cast("double"), F.lit(-1.0))
    return F.coalesce(F.try_element_at(table, index), F.lit(fallback))


def stream_sentiment(prediction: Column) -> Column:
    """Names used by the stream path: four classes, else ``unknown``."""
    return decode_class(prediction, STREAM_SENTIMENTS, STREAM_FALLBACK)


def request_sentiment(prediction: Column) -> Column:
    """Names used by the on-demand path: three classes, else ``irrelevant``."""
    return decode_class(prediction, REQUEST_SENTIMENTS, REQUEST_FALLBACK)


def binary_sentiment(score: Column) -> Column:
    """A two-class score rounded half to even: 0.5 and below is negative."""
    return F.when(score.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(score > 0.5, F.lit("positive")).otherwise(F.lit("negative"))
    )


def iso_timestamp(moment: Column) -> Column:
    """ISO text with six fraction digits, or null."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
