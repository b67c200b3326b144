"""Scoring text with a fitted pipeline: the same code for tables and streams."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.sql import DataFrame

from textpulse.functions import request_sentiment, stream_sentiment

FITTED = "fitted"
STREAM = "stream"
REQUEST = "request"


def _label_stages(model: PipelineModel) -> list[StringIndexerModel]:
    return [s for s in model.stages if isinstance(s, StringIndexerModel)]


def without_label_stage(model: PipelineModel) -> PipelineModel:
    """The pipeline for text that has no label column."""
    return PipelineModel([s for s in model.stages if not isinstance(s, StringIndexerModel)])


def score(
    model: PipelineModel,
    df: DataFrame,
    labelled: bool = False,
    names: str = FITTED,
    output: str = "sentiment_prediction",
) -> DataFrame:
    """Add ``prediction`` and its name.

    ``labelled=True`` runs the label stage too, which drops rows whose label is null
    or was not seen in training; otherwise every row is scored. ``names`` chooses the
    label order the model was fitted with (the default) or one of the fixed tables.
    """
    scorer = model if labelled else without_label_stage(model)
    scored = scorer.transform(df)
    if names == STREAM:
        return scored.withColumn(output, stream_sentiment(scored["prediction"]))
    if names == REQUEST:
        return scored.withColumn(output, request_sentiment(scored["prediction"]))
    stages = _label_stages(model)
    if not stages:
        raise ValueError("the pipeline has no label stage to name its classes; pass names")
    labels = list(stages[0].labels)
    decoder = IndexToString(inputCol="prediction", outputCol=output, labels=labels)
    return decoder.transform(scored)
