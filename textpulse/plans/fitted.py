"""Fitted feature stages made from tables.

A vocabulary or an idf that Spark has worked out as a table becomes a Spark ML model by writing
the files the model's own reader expects and loading them: the terms go from executors to the
shared folder to the JVM, none of them through Python.
"""

from __future__ import annotations

import json
import time

from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, IDF, IDFModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import Params
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.session import new_folder

# The classes that Spark's readers look for.
COUNTS_CLASS = "org.apache.spark.ml.feature.CountVectorizerModel"
IDF_CLASS = "org.apache.spark.ml.feature.IDFModel"
SELECTOR_CLASS = "org.apache.spark.ml.feature.ChiSqSelectorModel"


def written_stage(stage: Params, class_name: str, data: DataFrame, settings: dict) -> str:
    """Files of a saved model: ``metadata``, one JSON text, and ``data``, one row."""
    spark = data.sparkSession
    path = new_folder(spark, "stage")
    metadata = {
        "class": class_name,
        "timestamp": int(time.time() * 1000),
        "sparkVersion": spark.version,
        "uid": stage.uid,
        "paramMap": settings,
        "defaultParamMap": {},
    }
    spark.range(1).select(F.lit(json.dumps(metadata)).alias("value")).coalesce(1).write.text(f"{path}/metadata")
    data.write.parquet(f"{path}/data")
    return path


def in_order(terms: DataFrame, value: str, name: str) -> DataFrame:
    """One row: ``value`` of every row of a vocabulary as the array ``name``, by ``index``."""
    ranked = F.sort_array(F.collect_list(F.struct("index", F.expr(value).alias("v"))))
    return terms.agg(ranked.alias("ranked")).select(F.col("ranked.v").alias(name))


def vocabulary_model(stage: CountVectorizer, vocabulary: DataFrame) -> CountVectorizerModel:
    """The counter of a one-row table ``(vocabulary array)``."""
    settings = {
        "inputCol": stage.getInputCol(),
        "outputCol": stage.getOutputCol(),
        "vocabSize": stage.getVocabSize(),
        "binary": stage.getBinary(),
        "minTF": stage.getMinTF(),
    }
    return CountVectorizerModel.load(written_stage(stage, COUNTS_CLASS, vocabulary, settings))


def idf_model(stage: IDF, weights: DataFrame) -> IDFModel:
    """The weighter of a one-row table ``(idf array, docFreq array, numDocs)``."""
    settings = {
        "inputCol": stage.getInputCol(),
        "outputCol": stage.getOutputCol(),
        "minDocFreq": stage.getMinDocFreq(),
    }
    row = weights.select(array_to_vector("idf").alias("idf"), "docFreq", "numDocs")
    return IDFModel.load(written_stage(stage, IDF_CLASS, row, settings))
