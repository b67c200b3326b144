"""Classification metrics from one grouped count.

``outcome_counts`` is the only pass over the predictions. Its result has at most
(classes x classes) rows, and the matrix and all four metrics come from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outcome_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Rows per (label, prediction)."""
    pair = df.select(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    )
    return pair.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def confusion_matrix(counts: DataFrame, classes: Sequence[float]) -> DataFrame:
    """True classes as rows, predicted classes as columns, zero where nothing fell.

    Square over ``classes`` and every class that occurs as a label or a prediction; rows
    without a label or a prediction have no cell.
    """
    seen = counts.select(F.explode(F.array("label", "prediction")).alias("c")).dropna().distinct()
    # As many rows as there are classes.
    every = sorted({float(c) for c in classes} | {r["c"] for r in seen.collect()})
    cells = [
        F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("n"))), F.lit(0)).alias(f"predicted_{c:g}")
        for c in every
    ]
    spark = counts.sparkSession
    rows = spark.createDataFrame([(c,) for c in every], "label double")
    return rows.join(counts, "label", "left").groupBy("label").agg(*cells)


def class_totals(counts: DataFrame) -> DataFrame:
    """Per class: rows that are it, rows predicted as it, and rows where both hold."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    as_true = F.struct(
        F.col("label").alias("class"),
        F.col("n").alias("actual"),
        zero.alias("predicted"),
        hit.cast("bigint").alias("correct"),
    )
    as_predicted = F.struct(
        F.col("prediction").alias("class"),
        zero.alias("actual"),
        F.col("n").alias("predicted"),
        zero.alias("correct"),
    )
    sides = counts.select(F.inline(F.array(as_true, as_predicted)))
    return sides.groupBy("class").agg(
        F.sum("actual").alias("actual"),
        F.sum("predicted").alias("predicted"),
        F.sum("correct").alias("correct"),
    )


def report_from_counts(counts: DataFrame) -> DataFrame:
    """One row: accuracy, weighted F1, weighted precision and weighted recall."""
    correct = F.col("correct")
    precision = F.when(F.col("predicted") > 0, correct / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("actual") > 0, correct / F.col("actual")).otherwise(0.0)
    # correct / ((actual + predicted) / 2) is the harmonic mean of the two.
    f1 = 2.0 * correct / (F.col("actual") + F.col("predicted"))
    rows = F.sum("actual")

    def weighted(measure):
        return F.sum(F.col("actual") * measure) / rows

    return class_totals(counts).agg(
        rows.alias("n_rows"),
        (F.sum(correct) / rows).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
    )


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    return report_from_counts(outcome_counts(df, label, prediction))
