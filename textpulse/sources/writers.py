"""Sinks: JSON lines, delimited summary, append log, fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.schemas import LOG_COLUMNS, SUMMARY_COLUMNS


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per row, written in parallel."""
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    """Delimited text that ``read_tweet_csv`` and ``read_labelled_csv`` read back."""
    (
        df.write.mode(mode)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", True)
        .option("emptyValue", "")
        .csv(path)
    )


def write_summary(summary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The frame summary under its fixed header: a few ranked rows, so one file."""
    write_csv(summary.toDF(*SUMMARY_COLUMNS).coalesce(1), path, header=True, mode=mode)


def scored_log(scored: DataFrame, sentiment: str = "sentiment") -> DataFrame:
    """Log records: UTC time of scoring, text, class and name, for any number of rows."""
    made = {"timestamp": F.current_timestamp(), "sentiment": F.col(sentiment)}
    return scored.select(*[made.get(c, F.col(c)).alias(c) for c in LOG_COLUMNS])


def append_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load once per job and pass the model on; loading reads several files."""
    return PipelineModel.load(path)
