"""Regressions on hash buckets, fitted on the buckets that occur, the commonest first.

Each row of every iteration reads a weight and adds to a gradient at its features, for each class. Buckets lie in no
order, so common words are spread over all of the weights, megabytes of them, and hardly one is in a core's cache. By
frequency they lie side by side. The problem and its optimum are the same: a bucket that no row has gets weight zero,
and sums run in another order. The model has its weights where the buckets were.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, IDFModel
from pyspark.ml.linalg import DenseMatrix, MatrixUDT, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from textpulse.plans.fitted import written_stage
from textpulse.session import new_folder, ready_workers

# Fixed value: the class that Spark's reader looks for.
REGRESSION_CLASS = "org.apache.spark.ml.classification.LogisticRegressionModel"
BOUNDS = (
    "lowerBoundsOnCoefficients", "upperBoundsOnCoefficients", "lowerBoundsOnIntercepts", "upperBoundsOnIntercepts",
)


def hashes(stages: Sequence, classifier) -> bool:
    """Whether a regression without bounds or row weights reads the idf of hash buckets."""
    if not isinstance(classifier, LogisticRegression) or any(classifier.isSet(b) for b in (*BOUNDS, "weightCol")):
        return False
    buckets = {s.getOutputCol() for s in stages if isinstance(s, HashingTF)}
    weighed = {s.getOutputCol() for s in stages if isinstance(s, IDF) and s.getInputCol() in buckets}
    return classifier.getFeaturesCol() in weighed


def _renamed(places):
    """Vectors whose features have the numbers ``places`` says; those it has no number for are zero in all rows."""

    def rename(batches):
        new, width = places.value, int(places.value.max(initial=-1)) + 1
        for batch in batches:
            vector, n = batch.column(0), batch.num_rows
            dense = vector.field("type").to_numpy(zero_copy_only=False) == 1
            values = vector.field("values")
            bounds = np.asarray(values.offsets, np.int64)
            held, weights = np.diff(bounds), np.asarray(values.values)[bounds[0] : bounds[-1]]
            row = np.repeat(np.arange(n), held)
            index = np.arange(len(row)) - np.repeat(bounds[:-1] - bounds[0], held)
            if not dense.all():
                index[~dense[row]] = vector.field("indices").flatten().to_numpy()
            index = new[index].astype(np.int64)
            kept = index >= 0
            row, index, weights = row[kept], index[kept], weights[kept]
            order = np.argsort(row * np.int64(max(width, 1)) + index)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32))
            made = pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(n, np.int8)),
                    pa.array(np.full(n, width, np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(index[order].astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(weights[order])),
                ],
                names=["type", "size", "indices", "values"],
            )
            yield pa.record_batch([made, batch.column(1)], names=["features", "label"])

    return rename


def by_frequency(weigher: IDFModel) -> np.ndarray:
    """The new number of every bucket: its rank by texts, ties by number; -1 for buckets without a text."""
    texts = np.asarray(weigher.docFreq, np.int64)
    places = np.full(len(texts), -1, np.int32)
    order = np.argsort(-texts, kind="stable")[: np.count_nonzero(texts)]
    places[order] = np.arange(len(order), dtype=np.int32)
    return places


def renumbered(rows: DataFrame, places: np.ndarray, features: str, label: str) -> DataFrame:
    """(features, label) of the rows, the features renumbered, stored."""
    spark = rows.sparkSession
    ready_workers(spark)
    source = rows.select(F.unwrap_udt(features).alias("features"), F.col(label).alias("label"))
    number = StructField("label", DoubleType())
    made = source.mapInArrow(_renamed(spark.sparkContext.broadcast(places)), StructType([StructField("features", VectorUDT.sqlType()), number]))
    path = new_folder(spark, "features")
    made.write.parquet(path)
    return spark.read.schema(StructType([StructField("features", VectorUDT()), number])).parquet(path)


def fit(classifier: LogisticRegression, made: Sequence, rows: DataFrame, pack: Callable[[DataFrame], DataFrame]) -> LogisticRegressionModel:
    """The regression on ``rows``, whose features the fitted stages ``made`` gave; ``pack`` deals the stored rows out."""
    weigher = next(s for s in made if isinstance(s, IDFModel) and s.getOutputCol() == classifier.getFeaturesCol())
    places = by_frequency(weigher)
    if places.max(initial=-1) < 0:
        return classifier.fit(rows)
    stored = pack(renumbered(rows, places, classifier.getFeaturesCol(), classifier.getLabelCol()))
    names = {classifier.featuresCol: "features", classifier.labelCol: "label"}
    found = classifier.copy(names).fit(stored)
    weights = np.zeros((found.coefficientMatrix.numRows, len(places)))
    weights[:, places >= 0] = found.coefficientMatrix.toArray()[:, places[places >= 0]]
    # A feature's weights side by side, for scoring; one row of weights has to be a row.
    matrix = DenseMatrix(*weights.shape, weights.ravel(order="F"), isTransposed=len(weights) == 1)
    spark = rows.sparkSession
    schema = StructType(
        [
            StructField("numClasses", IntegerType()), StructField("numFeatures", IntegerType()), StructField("interceptVector", VectorUDT()),
            StructField("coefficientMatrix", MatrixUDT()), StructField("isMultinomial", BooleanType()),
        ]
    )
    row = (found.numClasses, len(places), found.interceptVector, matrix, len(weights) > 1)
    settings = {param.name: value for param, value in classifier.extractParamMap().items()}
    data = spark.createDataFrame([row], schema, verifySchema=False).coalesce(1)
    return LogisticRegressionModel.load(written_stage(classifier, REGRESSION_CLASS, data, settings))
