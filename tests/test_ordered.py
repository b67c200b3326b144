import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from textpulse.plans import models, ordered, training
from textpulse.session import new_folder
from textpulse.sources.writers import load_model, save_model


@pytest.fixture(scope="module")
def rows(spark):
    names, words = ("up", "down", "flat"), "good great fine bad awful sad table chair lamp".split()
    data = []
    for i in range(150):
        k = i * 7 % 3
        text = " ".join([words[3 * k + i % 3], words[i * 5 % 9], words[i * i % 9], "the", "the"])
        data.append((i, names[k] if i % 50 else None, text))
    return spark.createDataFrame(data, "id long, sentiment string, tweet string").repartition(3, "id")


@pytest.mark.parametrize("classes", [3, 2])
def test_buckets_by_frequency_give_the_plain_model(spark, rows, classes):
    rows = rows if classes == 3 else rows.filter("sentiment <> 'flat'")
    stages = models.lr_hashed(buckets=1 << 12, max_iter=20).getStages()
    if classes == 2:
        stages = [*stages[:-1], LogisticRegression(maxIter=20)]
    pipeline = Pipeline(stages=stages)
    ours, plain = training.fit_classifier(pipeline, rows), pipeline.fit(rows)
    assert [type(s) for s in ours.stages] == [type(s) for s in plain.stages]
    mine, theirs = ours.stages[-1], plain.stages[-1]
    assert mine.uid == theirs.uid and mine.numClasses == theirs.numClasses == classes
    assert np.allclose(mine.coefficientMatrix.toArray(), theirs.coefficientMatrix.toArray(), rtol=1e-6, atol=1e-8)
    assert np.allclose(mine.interceptVector.toArray(), theirs.interceptVector.toArray(), rtol=1e-6, atol=1e-8)
    assert np.count_nonzero(mine.coefficientMatrix.toArray().any(axis=0)) <= 10
    path = new_folder(spark, "test-regression")
    save_model(ours, path)
    found = {r["id"]: r["probability"] for r in load_model(path).transform(rows).select("id", "probability").collect()}
    expected = {r["id"]: r["probability"] for r in plain.transform(rows).select("id", "probability").collect()}
    assert found.keys() == expected.keys()
    assert all(np.allclose(found[i].toArray(), expected[i].toArray(), atol=1e-9) for i in expected)


def test_the_regression_reads_only_buckets_that_occur_commonest_first(rows, monkeypatch):
    read = []
    fit = LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, df, *a: read.append(df) or fit(self, df, *a))
    training.fit_classifier(models.lr_hashed(buckets=1 << 12, max_iter=2), rows)
    vectors = [r["features"] for r in read[0].collect()]
    assert {v.size for v in vectors} == {10} and all((np.diff(v.indices) > 0).all() for v in vectors)
    held = np.bincount(np.concatenate([v.indices for v in vectors]), minlength=10)
    assert held[0] == len(vectors) == 147
    assert "tweet" not in read[0]._jdf.queryExecution().optimizedPlan().toString()


def test_dense_sparse_and_empty_vectors_are_renumbered(spark):
    vectors = [Vectors.dense([1.0, 0.0, 2.0, 3.0]), Vectors.sparse(4, [0, 3], [5.0, 6.0]), Vectors.sparse(4, [], []), Vectors.sparse(4, [2], [7.0])]
    rows = spark.createDataFrame([(v, float(i)) for i, v in enumerate(vectors)], ["f", "l"]).coalesce(1)
    found = ordered.renumbered(rows, np.array([2, -1, 1, 0], np.int32), "f", "l").orderBy("label").collect()
    assert [r["features"] for r in found] == [
        Vectors.sparse(3, [0, 1, 2], [3.0, 2.0, 1.0]), Vectors.sparse(3, [0, 2], [6.0, 5.0]), Vectors.sparse(3, [], []), Vectors.sparse(3, [1], [7.0]),
    ]


def test_other_regressions_are_fitted_as_before():
    stages = models.lr_hashed().getStages()
    assert ordered.hashes(stages[:-1], stages[-1])
    assert not ordered.hashes(stages[:-1], stages[-1].copy().setWeightCol("w"))
    assert not ordered.hashes(models.lr_vocabulary().getStages()[:-1], stages[-1])
    assert not ordered.hashes(models.forest_hashed().getStages()[:-1], models.forest_hashed().getStages()[-1])
