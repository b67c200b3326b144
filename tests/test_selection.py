"""The presence selector against Spark's chi-square on presence, and as a saved stage."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import ChiSqSelectorModel, CountVectorizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from textpulse.plans import models
from textpulse.plans.selection import PresenceSelector, entries
from textpulse.plans.training import fit_classifier
from textpulse.session import new_folder
from textpulse.sources.writers import load_model, save_model


@pytest.fixture(scope="module")
def rows(spark):
    data = []
    for i in range(60):
        label = float(i % 3)
        values = [0.1 * i if i % 3 == 0 else 0.0, float(i % 2), 1.0 + i, float(i % 5 == 0) * i, 0.0, float(i % 3 == 1)]
        dense = Vectors.dense(values)
        data.append((label, dense if i % 2 else Vectors.sparse(6, [(k, v) for k, v in enumerate(values)])))
    data.append((None, Vectors.dense([1.0] * 6)))
    return spark.createDataFrame(data, ["label", "features"]).repartition(3)


def test_entries_are_the_places_that_are_not_zero(spark):
    data = [(Vectors.dense([0.0, 2.0, 0.0]),), (Vectors.sparse(5, [1, 3], [0.0, 4.0]),), (Vectors.dense([]),), (Vectors.sparse(3, [], []),)]
    df = spark.createDataFrame(data, ["v"])
    assert [r[0] for r in df.select(entries(F.col("v"))).collect()] == [[1], [3], [], []]


def test_scores_are_sparks_on_presence(spark, rows):
    found = {r["index"]: r["chi_square"] for r in PresenceSelector().scores(rows).collect()}
    flags = rows.filter("label IS NOT NULL").rdd.map(
        lambda r: (r["label"], Vectors.dense([float(v != 0) for v in r["features"].toArray()]))
    )
    expected = ChiSquareTest.test(spark.createDataFrame(flags.collect(), ["label", "features"]), "features", "label").first()
    assert set(found) == {0, 1, 2, 3, 5}  # 4 is zero everywhere
    for index, score in found.items():
        assert score == pytest.approx(expected["statistics"][index], abs=1e-9)


def test_best_features_are_kept_with_their_weights(rows):
    model = PresenceSelector(numTopFeatures=2, outputCol="kept").fit(rows)
    assert isinstance(model, ChiSqSelectorModel) and model.selectedFeatures == [0, 5]
    for r in model.transform(rows).collect():
        assert r["kept"].toArray().tolist() == [r["features"][0], r["features"][5]]
    assert PresenceSelector(numTopFeatures=99).fit(rows).selectedFeatures == [0, 1, 2, 3, 5]


def test_estimator_and_model_are_saved(spark, rows):
    path = new_folder(spark, "selector")
    PresenceSelector(numTopFeatures=3, featuresCol="features", outputCol="kept").save(path)
    again = PresenceSelector.load(path)
    assert (again.getNumTopFeatures(), again.getOutputCol()) == (3, "kept")
    fitted = Pipeline(stages=[again]).fit(rows)
    path = new_folder(spark, "selector-model")
    save_model(fitted, path)
    assert load_model(path).stages[0].selectedFeatures == fitted.stages[0].selectedFeatures


def test_no_limit_on_distinct_weights(spark):
    """More than 10,000 weights in a feature, which Spark's own selector refuses."""
    data = spark.range(11_000).select(
        (F.col("id") % 2).cast("double").alias("label"),
        F.array(F.concat(F.lit("w"), (F.col("id") % 2).cast("string")), F.lit("all")).alias("words"),
    )
    counted = CountVectorizer(inputCol="words", outputCol="n").fit(data).transform(data)
    scaled = counted.withColumn("id", F.monotonically_increasing_id() + 1).select(
        "label", array_to_vector(F.transform(vector_to_array("n"), lambda v: v * F.col("id").cast("double"))).alias("features")
    )
    model = PresenceSelector(numTopFeatures=2).fit(scaled)
    assert model.selectedFeatures == [1, 2]  # "all" is 0, the commonest


def test_ngram_regression_is_saved_and_loaded(spark):
    data = [(i, ["x", "y"][i % 2], f"{['good fine', 'bad sad'][i % 2]} the {i % 7}") for i in range(40)]
    rows = spark.createDataFrame(data, "id long, sentiment string, tweet string")
    model = fit_classifier(models.lr_ngrams(size=100, min_doc_freq=0, selected=6, max_iter=5), rows)
    path = new_folder(spark, "ngrams")
    save_model(model, path)
    scored = load_model(path).transform(rows).filter("label = prediction")
    assert scored.count() == 40
