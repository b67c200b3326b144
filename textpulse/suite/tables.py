"""Profiles, class names and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from textpulse.functions import binary_sentiment, request_sentiment, stream_sentiment
from textpulse.operators import metrics, profile
from textpulse.schemas import SCORED_COLUMNS
from textpulse.sources.readers import read_table
from textpulse.suite.inputs import documents_with_labels, tweets
from textpulse.suite.registry import query

STREAM_CASE = """CASE label WHEN 0 THEN 'negative' WHEN 1 THEN 'positive'
  WHEN 2 THEN 'neutral' WHEN 3 THEN 'irrelevant' ELSE 'unknown' END"""
REQUEST_CASE = """CASE label WHEN 0 THEN 'negative' WHEN 1 THEN 'positive'
  WHEN 2 THEN 'neutral' ELSE 'irrelevant' END"""


@query("row_count", "SELECT count(*) AS n_rows FROM documents")
def row_count(spark, sf):
    return profile.row_count(read_table(spark, sf, "documents"))


@query(
    "null_counts",
    """SELECT count(*) FILTER (d.doc_id IS NULL) AS doc_id, count(*) FILTER (text IS NULL) AS text,
      count(*) FILTER (lang IS NULL) AS lang, count(*) FILTER (source IS NULL) AS source,
      count(*) FILTER (n_chars IS NULL) AS n_chars, count(*) FILTER (quality IS NULL) AS quality,
      count(*) FILTER (toxic IS NULL) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def null_counts(spark, sf):
    return profile.null_counts(documents_with_labels(spark, sf))


@query(
    "describe_numeric",
    """SELECT 'n_chars' AS "column", count(n_chars) AS n, round(avg(n_chars), 6) AS mean,
      round(stddev_samp(n_chars), 6) AS stddev, min(n_chars)::VARCHAR AS min,
      max(n_chars)::VARCHAR AS max FROM documents""",
)
def describe_numeric(spark, sf):
    return _rounded_profile(read_table(spark, sf, "documents"), ["n_chars"])


@query(
    "describe_columns",
    """SELECT 'doc_id' AS "column", count(doc_id) AS n, round(avg(doc_id), 6) AS mean,
      round(stddev_samp(doc_id), 6) AS stddev, min(doc_id)::VARCHAR AS min,
      max(doc_id)::VARCHAR AS max FROM documents
    UNION ALL SELECT 'source', count(source), NULL, NULL, min(source), max(source) FROM documents
    UNION ALL SELECT 'lang', count(lang), NULL, NULL, min(lang), max(lang) FROM documents
    UNION ALL SELECT 'text', count(text), NULL, NULL, min(text), max(text) FROM documents""",
)
def describe_columns(spark, sf):
    return _rounded_profile(
        read_table(spark, sf, "documents"), ["doc_id", "source", "lang", "text"]
    )


def _rounded_profile(df, columns):
    rounded = {"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)}
    return profile.describe_columns(df, columns).withColumns(rounded)


@query("preview", "SELECT doc_id, text, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 20")
def preview(spark, sf):
    return profile.preview(read_table(spark, sf, "documents"), ["doc_id"])


@query("decode_stream", f"SELECT vec_id, {STREAM_CASE} AS sentiment_prediction FROM embeddings")
def decode_stream(spark, sf):
    scored = read_table(spark, sf, "embeddings")
    return scored.select(
        "vec_id", stream_sentiment(F.col("label")).alias("sentiment_prediction")
    )


@query("decode_request", f"SELECT vec_id, {REQUEST_CASE} AS sentiment FROM embeddings")
def decode_request(spark, sf):
    scored = read_table(spark, sf, "embeddings")
    return scored.select("vec_id", request_sentiment(F.col("label")).alias("sentiment"))


@query(
    "decode_binary",
    """SELECT event_id, CASE WHEN value / 100 > 0.5 THEN 'positive' ELSE 'negative' END AS sentiment
    FROM events WHERE value IS NOT NULL""",
)
def decode_binary(spark, sf):
    events = read_table(spark, sf, "events").filter(F.col("value").isNotNull())
    return events.select("event_id", binary_sentiment(F.col("value") / 100).alias("sentiment"))


@query(
    "project_scored",
    f"""SELECT doc_id AS id, source AS game, text AS tweet, {STREAM_CASE} AS sentiment_prediction,
      label::DOUBLE AS prediction FROM documents JOIN embeddings ON doc_id = vec_id""",
)
def project_scored(spark, sf):
    classes = read_table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("double").alias("prediction")
    )
    scored = tweets(spark, sf).join(classes, "id")
    named = scored.withColumn("sentiment_prediction", stream_sentiment(F.col("prediction")))
    return named.select(*SCORED_COLUMNS)


def rating_pairs(spark, sf):
    """(label, prediction) pairs: the rating against the absence of the toxic mark."""
    return read_table(spark, sf, "labels").select(
        F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction")
    )


@query(
    "confusion_matrix",
    """SELECT quality::DOUBLE AS label, count(*) FILTER (toxic = 1) AS predicted_0,
      count(*) FILTER (toxic = 0) AS predicted_1 FROM labels GROUP BY quality""",
)
def confusion_matrix(spark, sf):
    counts = metrics.outcome_counts(rating_pairs(spark, sf))
    return metrics.confusion_matrix(counts, classes=[0, 1])


def report_sql(pairs: str) -> str:
    """The four metrics from a relation with ``label`` and ``prediction``."""
    return f"""
    WITH pairs AS ({pairs}), total AS (SELECT count(*) AS n FROM pairs),
    classes AS (SELECT label AS c FROM pairs UNION SELECT prediction FROM pairs),
    per AS (
      SELECT c, (SELECT count(*) FROM pairs WHERE label = c) AS s,
             (SELECT count(*) FROM pairs WHERE prediction = c) AS p,
             (SELECT count(*) FROM pairs WHERE label = c AND prediction = c) AS t
      FROM classes),
    each AS (
      SELECT s, t, CASE WHEN p = 0 THEN 0 ELSE t / p END AS pr,
             CASE WHEN s = 0 THEN 0 ELSE t / s END AS re FROM per)
    SELECT (SELECT n FROM total) AS n_rows,
      round(sum(t) / (SELECT n FROM total), 6) AS accuracy,
      round(sum(s * CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END)
        / (SELECT n FROM total), 6) AS f1,
      round(sum(s * pr) / (SELECT n FROM total), 6) AS weighted_precision,
      round(sum(s * re) / (SELECT n FROM total), 6) AS weighted_recall
    FROM each"""


def rounded_report(report):
    names = ("accuracy", "f1", "weighted_precision", "weighted_recall")
    return report.withColumns({name: F.round(name, 6) for name in names})


@query(
    "metrics_report",
    report_sql("SELECT quality AS label, 1 - toxic AS prediction FROM labels"),
)
def metrics_report(spark, sf):
    return rounded_report(metrics.classification_report(rating_pairs(spark, sf)))
