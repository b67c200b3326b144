import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from textpulse.operators import metrics, profile

SCHEMA = "label double, prediction double"


def test_null_counts_of_an_empty_table_are_zero(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert tuple(profile.null_counts(df).first()) == (0, 0)


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert tuple(profile.null_counts(df).first()) == (1, 2)
    assert profile.row_count(df).first()["n_rows"] == 3


def test_profile_equals_describe(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (6, None)], "n int, s string")
    theirs = {r["summary"]: r for r in df.describe().collect()}
    for row in profile.describe_columns(df).collect():
        name = row["column"]
        assert str(row["n"]) == theirs["count"][name]
        assert row["min"] == theirs["min"][name] and row["max"] == theirs["max"][name]
        for ours, key in ((row["mean"], "mean"), (row["stddev"], "stddev")):
            text = theirs[key][name]
            assert (ours is None) == (text is None)
            assert ours is None or math.isclose(ours, float(text))


def test_preview(spark):
    assert [r["id"] for r in profile.preview(spark.range(50), ["id"], 3).collect()] == [0, 1, 2]


def test_confusion_layout(spark):
    pairs = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (1.0, 0.0)]
    counts = metrics.outcome_counts(spark.createDataFrame(pairs, SCHEMA))
    rows = metrics.confusion_matrix(counts, [0, 1]).orderBy("label").collect()
    assert [tuple(r)[1:] for r in rows] == [(1, 0), (2, 1)]


@pytest.mark.parametrize("classes", [2, 5])
def test_report_equals_the_evaluator(spark, classes):
    df = spark.range(500).select(
        (F.col("id") % classes).cast("double").alias("label"),
        # One class is never predicted, and one predicted class never occurs.
        F.when(F.col("id") % 7 < 4, F.col("id") % classes)
        .otherwise((F.col("id") * 3) % (classes + 1))
        .cast("double")
        .alias("prediction"),
    )
    df = df.filter("prediction <> 1")
    report = metrics.classification_report(df).first()
    names = {
        "accuracy": "accuracy",
        "f1": "f1",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
    }
    for ours, theirs in names.items():
        expected = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert math.isclose(report[ours], expected, rel_tol=1e-12), ours
    assert report["n_rows"] == df.count()


def test_confusion_keeps_every_class(spark):
    counts = metrics.outcome_counts(spark.createDataFrame([(0.0, 2.0), (1.0, 1.0)], "label double, prediction double"))
    rows = metrics.confusion_matrix(counts, [0, 1]).orderBy("label").collect()
    assert [tuple(r) for r in rows] == [(0.0, 0, 0, 1), (1.0, 0, 1, 0), (2.0, 0, 0, 0)]
