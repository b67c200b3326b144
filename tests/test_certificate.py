"""The gradient of a fit against numpy, and what a model without weights looks like."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from textpulse.plans import models
from textpulse.plans.certificate import INTERCEPT, certificate, loss_gradients
from textpulse.plans.training import fit_classifier


@pytest.fixture(scope="module")
def rows(spark):
    words = {"x": "good fine well nice", "y": "bad sad ill poor", "z": "cat dog hen cow"}
    data = []
    for i in range(90):
        label = "xyz"[i % 3] if i % 5 else "xyz"[(i + 1) % 3]  # some rows contradict others
        pool = words["xyz"[i % 3]].split()
        data.append((i, label, f"{pool[i % 4]} {pool[(i * 7) % 4]} the"))
    return spark.createDataFrame(data, "id long, sentiment string, tweet string").repartition(3)


def pipeline(**settings):
    return models.lr_vocabulary(min_doc_freq=0, **settings)


def test_gradients_are_those_of_numpy(rows):
    model = fit_classifier(pipeline(max_iter=3), rows)
    scored = model.transform(rows)
    data = scored.select("features", "probability", "label").collect()
    x = np.array([np.append(r["features"].toArray(), 1.0) for r in data])
    p = np.array([r["probability"].toArray() for r in data])
    y = np.eye(3)[[int(r["label"]) for r in data]]
    shares = y.mean(axis=0)
    got = {(r["class"], r["index"]): r for r in loss_gradients(scored, shares.tolist()).collect()}
    for name, expected in (("fitted", (p - y).T @ x / len(x)), ("start", (shares - y).T @ x / len(x))):
        for k in range(3):
            for j in range(x.shape[1]):
                found = got.get((k, INTERCEPT if j == x.shape[1] - 1 else j))
                assert (found[name] if found else 0.0) == pytest.approx(expected[k, j], abs=1e-12)


def test_a_fit_settles_and_a_model_without_weights_does_not(rows):
    good = certificate(fit_classifier(pipeline(), rows), rows).collect()
    assert sum(r["n_rows"] for r in good) == 90
    assert all(r["fitted"] < 0.01 * r["start"] for r in good)
    # Intercepts alone meet the rows per class exactly, which moments cannot tell from a fit.
    flat = fit_classifier(pipeline(), rows)
    regression = flat.stages[-1]
    empty = models.LogisticRegression(family="multinomial", regParam=1e6, elasticNetParam=1.0).fit(
        PipelineModel(flat.stages[:-1]).transform(rows)
    )
    assert empty.numFeatures == regression.numFeatures and not empty.coefficientMatrix.toArray().any()
    found = certificate(PipelineModel([*flat.stages[:-1], empty]), rows)
    assert all(r["fitted"] > 0.9 * r["start"] for r in found.collect())
