import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from textpulse.plans import models, scoring, training, tuning
from textpulse.plans.training import bounded_share, evaluate, fit_classifier
from textpulse.session import new_folder
from textpulse.sources.writers import load_model, save_model

WORDS = {"up": "good great fine", "down": "bad awful sad", "flat": "table chair lamp"}


@pytest.fixture(scope="module")
def rows(spark):
    data = []
    for i in range(120):
        name = list(WORDS)[i % 3 if i % 4 else 0]
        pool = WORDS[name].split()
        extra = list(WORDS.values())[i % 2].split()
        data.append((i, name, f"{pool[i % 3]} {pool[(i + 1) % 3]} {extra[i % 3]} the"))
    return spark.createDataFrame(data, "id long, sentiment string, tweet string").repartition(2, "id")


@pytest.fixture(scope="module")
def bayes(rows):
    return fit_classifier(models.nb_vocabulary(), rows)


@pytest.mark.parametrize(
    "build, settings",
    [
        (models.lr_vocabulary, {"min_doc_freq": 0, "max_iter": 10}),
        (models.lr_hashed, {"buckets": 1 << 10, "max_iter": 10}),
        (models.lr_ngrams, {"size": 200, "min_doc_freq": 0, "selected": 50, "max_iter": 10}),
        (models.lr_ngrams, {"size": 200, "min_doc_freq": 0, "selected": 50, "binary": True}),
        (models.nb_vocabulary, {}),
    ],
    ids=["lr_vocabulary", "lr_hashed", "lr_ngrams", "lr_ngrams_binary", "bayes"],
)
def test_stored_features_give_the_model_of_the_plain_pipeline(rows, build, settings):
    pipeline = build(**settings)

    def predictions(model):
        return {r["id"]: r["prediction"] for r in model.transform(rows).select("id", "prediction").collect()}

    ours = predictions(fit_classifier(pipeline, rows))
    assert ours == predictions(pipeline.fit(rows))
    assert len(set(ours.values())) > 1


def test_forest_learns(rows):
    """Its samples depend on row order, so no two fits need be equal."""
    pipeline = models.forest_hashed(buckets=32, trees=20, depth=6)
    scored = scoring.score(fit_classifier(pipeline, rows), rows, labelled=True)
    right = scored.filter("sentiment = sentiment_prediction").count()
    assert scored.count() == 120 and right > 70


def test_default_settings(spark):
    by_name = {
        "lr_vocabulary": (models.lr_vocabulary(), {"vocabSize": 65536, "minDocFreq": 5, "maxIter": 100}),
        "lr_ngrams": (models.lr_ngrams(), {"vocabSize": 16384, "numTopFeatures": 16384, "minDocFreq": 5}),
        "lr_hashed": (models.lr_hashed(), {"numFeatures": 262144, "maxIter": 100}),
        "bayes": (models.nb_vocabulary(), {"vocabSize": 262144, "smoothing": 1.0}),
        "forest": (models.forest_hashed(), {"numFeatures": 262144, "numTrees": 100, "maxDepth": 15}),
    }
    for name, (pipeline, expected) in by_name.items():
        found = {}
        for stage in pipeline.getStages():
            for param in stage.params:
                if param.name in expected and stage.isDefined(param):
                    found[param.name] = stage.getOrDefault(param)
        assert found == expected, name


def test_tuning_equals_the_cross_validator(rows):
    tuned = tuning.tune_naive_bayes(rows, "id")
    folded = rows.withColumn("fold", tuning.fold_of("id", 3).cast("int"))
    bayes = NaiveBayes()
    plain = CrossValidator(
        estimator=Pipeline(stages=[*models.nb_vocabulary().getStages()[:-1], bayes]),
        estimatorParamMaps=ParamGridBuilder().addGrid(bayes.smoothing, list(models.NB_SMOOTHING)).build(),
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
        numFolds=3,
        foldCol="fold",
    ).fit(folded)
    for ours, theirs in zip(tuned.accuracy.values(), plain.avgMetrics, strict=True):
        assert math.isclose(ours, theirs, rel_tol=1e-9)
    expected = plain.bestModel.transform(folded).select("id", "prediction").collect()
    got = {r["id"]: r["prediction"] for r in tuned.model.transform(rows).select("id", "prediction").collect()}
    assert got == {r["id"]: r["prediction"] for r in expected}


def test_labelled_mode_drops_what_it_does_not_know(spark, bayes):
    data = [(1, "up"), (2, "zz"), (3, None), (4, "UP")]
    df = spark.createDataFrame([(i, s, "good great") for i, s in data], "id long, sentiment string, tweet string")
    labelled = scoring.score(bayes, df, labelled=True).collect()
    assert [r["id"] for r in labelled] == [1]
    unlabelled = scoring.score(bayes, df).collect()
    assert sorted(r["id"] for r in unlabelled) == [1, 2, 3, 4]
    assert {r["sentiment_prediction"] for r in unlabelled} == {"up"}


def test_names_of_the_fixed_tables(spark, bayes):
    df = spark.createDataFrame([("good great",)], "tweet string")
    assert scoring.score(bayes, df, names=scoring.STREAM).first()["sentiment_prediction"] == "negative"
    got = scoring.score(bayes, df, names=scoring.REQUEST, output="sentiment").head(1)[0]
    assert got["sentiment"] == "negative" and got["prediction"] == 0.0


def test_saved_model_scores_alike(spark, bayes, rows):
    path = new_folder(spark, "test-model")
    save_model(bayes, path)
    save_model(bayes, path)
    loaded = load_model(path)
    first = {r["id"]: r["prediction"] for r in scoring.score(bayes, rows).collect()}
    assert {r["id"]: r["prediction"] for r in scoring.score(loaded, rows).collect()} == first


def test_scoring_adds_no_shuffle(bayes, rows, spark):
    flat = spark.createDataFrame([("a", "b")], "tweet string, sentiment string")
    plan = scoring.score(bayes, flat)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_fold_numbers_cover_every_fold(spark):
    folds = spark.range(300).select(tuning.fold_of("id", 3).alias("f")).groupBy("f").agg(F.count("*").alias("n"))
    assert sorted(r["f"] for r in folds.collect()) == [0, 1, 2]


@pytest.mark.parametrize("partitions", [1, 5])
def test_ties_at_the_vocabulary_cap_go_by_term(spark, partitions):
    data = [(1, "x", "d c b a"), (2, "y", "a b c d"), (3, "x", "e a")]
    rows = spark.createDataFrame(data, "id long, sentiment string, tweet string").repartition(partitions)
    model = fit_classifier(models.nb_vocabulary(size=3), rows)
    assert model.stages[1].vocabulary == ["a", "b", "c"]


def test_bounded_share_is_stable(spark):
    ids = spark.range(5000)
    some = [{r["id"] for r in bounded_share(ids.repartition(n), "id", 500).collect()} for n in (1, 7)]
    assert some[0] == some[1] and 400 < len(some[0]) < 600
    assert bounded_share(ids, "id", 5000).count() == 5000


FIVE = {
    "lr_vocabulary": (models.lr_vocabulary, {"min_doc_freq": 0, "max_iter": 10}),
    "lr_ngrams": (models.lr_ngrams, {"size": 200, "min_doc_freq": 0, "selected": 50, "max_iter": 10}),
    "lr_hashed": (models.lr_hashed, {"buckets": 1 << 10, "max_iter": 10}),
    "bayes": (models.nb_vocabulary, {}),
    "forest": (models.forest_hashed, {"buckets": 32, "trees": 10, "depth": 5}),
}


@pytest.mark.parametrize("name", FIVE)
def test_reports_are_those_of_the_evaluator(rows, name):
    build, settings = FIVE[name]
    test = rows.filter("id % 3 = 0")
    if name in ("lr_hashed", "bayes", "forest"):  # the others take a label they have not seen for an error
        test = test.unionByName(rows.filter("id = 1").selectExpr("999L AS id", "'new' AS sentiment", "tweet"))
    made = evaluate(build(**settings), rows.filter("id % 3 > 0"), test)
    report = made.report.first()
    scored = scoring.score(made.model, test, labelled=True)
    assert report["n_rows"] == 40 and made.seconds > 0
    for metric, column in (
        ("accuracy", "accuracy"), ("f1", "f1"), ("weightedPrecision", "weighted_precision"), ("weightedRecall", "weighted_recall"),
    ):
        assert math.isclose(report[column], MulticlassClassificationEvaluator(metricName=metric).evaluate(scored), abs_tol=1e-9)


def test_regression_parts_grow_with_the_root_of_the_data(spark):
    rows = [(Vectors.dense([1.0, 2.0, 3.0, 4.0]), float(i % 2)) for i in range(64)]
    stored = spark.createDataFrame(rows, ["features", "label"]).repartition(20)
    # 256 entries of 12 bytes against a gradient of 4 features, 2 classes and 8 bytes: 48 times.
    assert training._pack(stored).rdd.getNumPartitions() == 7
    assert training._pack(stored.filter("false")).rdd.getNumPartitions() >= 1
