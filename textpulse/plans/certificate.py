"""Proof that a fitted regression is at its optimum: the gradient of its loss.

Without regularisation the mean over the rows of (probability of a class - the row is of it) x feature
is zero for every class and feature at the optimum. One grouped aggregate gives all entries; the
largest, against the largest of a model with intercepts alone, says how far the fit has come.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.plans.selection import vector_entries

INTERCEPT = -1


def loss_gradients(scored: DataFrame, shares: list[float]) -> DataFrame:
    """(class, index, fitted, start): the two gradients of every class and feature.

    ``scored`` has ``features``, ``probability`` and ``label``. ``start`` is the gradient of the model
    whose probabilities are the class ``shares`` for every row. Features are summed by index with
    map-side combine; an index that is zero in every row has gradient zero and no row.
    """
    rows = scored.select("label", vector_to_array("probability").alias("p"), vector_entries(F.col("features")).alias("e"))
    ones = F.array(F.struct(F.lit(INTERCEPT).alias("index"), F.lit(1.0).alias("value")))
    entries = rows.select("label", "p", F.inline(F.concat("e", ones)))

    def total(probability: Column, k: int) -> Column:
        hit = (F.col("label") == float(k)).cast("double")
        return F.sum((probability - hit) * F.col("value"))

    sums = []
    for k, share in enumerate(shares):
        sums += [total(F.col("p")[k], k).alias(f"f{k}"), total(F.lit(share), k).alias(f"s{k}")]
    n = rows.agg(F.count("*")).scalar()
    classes = [
        F.struct(F.lit(k).alias("class"), (F.col(f"f{k}") / n).alias("fitted"), (F.col(f"s{k}") / n).alias("start"))
        for k in range(len(shares))
    ]
    return entries.groupBy("index").agg(*sums).select("index", F.inline(F.array(*classes)))


def certificate(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(label, n_rows, start, fitted): per class the largest entry of each gradient, over the training rows."""
    names = next(s.labels for s in model.stages if isinstance(s, StringIndexerModel))
    scored = model.transform(rows).select("features", "probability", "label")
    counts = {r["label"]: r["n"] for r in scored.groupBy("label").agg(F.count("*").alias("n")).collect()}  # classes
    total = sum(counts.values())
    gradients = loss_gradients(scored, [counts.get(float(k), 0) / total for k in range(len(names))])
    largest = gradients.groupBy("class").agg(
        F.max(F.abs("start")).alias("start"), F.max(F.abs("fitted")).alias("fitted")
    )
    known = rows.sparkSession.createDataFrame(
        [(k, name, counts.get(float(k), 0)) for k, name in enumerate(names)], "class int, label string, n_rows long"
    )
    return known.join(largest, "class").select("label", "n_rows", "start", "fitted")
