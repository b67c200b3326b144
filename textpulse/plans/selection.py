"""Choosing features by chi-square on presence, as a stage of a pipeline.

Spark's own selector takes every distinct weight of a feature for a category and refuses features
with more than 10,000 of them. Here a feature is there or not, so weights may be any numbers, and
those that are kept reach the classifier as they are.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import ChiSqSelectorModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.operators.terms import presence_chi_square, top_terms
from textpulse.plans.fitted import SELECTOR_CLASS, written_stage
from textpulse.session import stored

#: Statistics that agree to this many places are ties; the smaller index is kept.
TIE_PLACES = 6


def vector_entries(vector: Column) -> Column:
    """(index, value) of the entries of a vector that are not zero, sparse or dense."""
    parts = F.unwrap_udt(vector)
    places = F.when(parts["type"] == 0, parts["indices"]).otherwise(
        F.when(F.size(parts["values"]) > 0, F.sequence(F.lit(0), F.size(parts["values"]) - 1)).otherwise(F.array())
    )
    pairs = F.arrays_zip(places.alias("index"), parts["values"].alias("value"))
    return F.filter(pairs, lambda p: p["value"] != 0)


def entries(vector: Column) -> Column:
    """Indices of the entries of a vector that are not zero."""
    return F.transform(vector_entries(vector), lambda p: p["index"])


class PresenceSelector(
    Estimator, HasFeaturesCol, HasLabelCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Keeps the ``numTopFeatures`` features whose presence says most about the label.

    Its model is Spark's ``ChiSqSelectorModel``, which any pipeline saves, loads and runs. Features
    that are zero in every row are never kept, rows without a label are not counted.
    """

    numTopFeatures = Param(Params._dummy(), "numTopFeatures", "most features kept", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, numTopFeatures=50, featuresCol="features", labelCol="label", outputCol="selected"):
        super().__init__()
        self._setDefault(numTopFeatures=50, outputCol="selected")
        self._set(**self._input_kwargs)

    def getNumTopFeatures(self) -> int:
        return self.getOrDefault(self.numTopFeatures)

    def scores(self, rows: DataFrame) -> DataFrame:
        """(index, df, chi_square) of every feature that occurs."""
        present = rows.select(
            F.col(self.getLabelCol()).alias("label"), entries(F.col(self.getFeaturesCol())).alias("index")
        )
        # Counted three ways: indices are few against the texts that the features came from.
        return presence_chi_square(stored(present, "present"), "index", "label")

    def _fit(self, rows: DataFrame) -> ChiSqSelectorModel:
        rounded = self.scores(rows).withColumn("chi_square", F.round("chi_square", TIE_PLACES))
        kept = top_terms(rounded, "chi_square", self.getNumTopFeatures(), ["index"])
        chosen = kept.agg(F.sort_array(F.collect_list("index")).alias("selectedFeatures"))
        settings = {
            "featuresCol": self.getFeaturesCol(),
            "labelCol": self.getLabelCol(),
            "outputCol": self.getOutputCol(),
            "numTopFeatures": self.getNumTopFeatures(),
        }
        return ChiSqSelectorModel.load(written_stage(self, SELECTOR_CLASS, chosen, settings))
