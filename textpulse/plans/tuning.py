"""Cross-validated choice of a naive Bayes smoothing, from counts per fold.

``pyspark.ml.tuning.CrossValidator`` reads the texts again for every fold and setting. Here they
are split into words and counted once, per (fold, class, term); each fold's model comes from the
total without the fold (see ``plans.bayes``). Then every text is scored once, by the models of
its own fold, for all settings. Fold membership is an md5 bucket of the key, so it does not
depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.functions import md5_bucket
from textpulse.plans import models
from textpulse.plans.bayes import count_texts, models_of
from textpulse.plans.models import FOLDS, NB_SMOOTHING, VOCABULARY_NB
from textpulse.session import stored


@dataclass(frozen=True)
class Tuned:
    """The refitted best pipeline, its setting, and the mean accuracy per setting."""

    model: PipelineModel
    smoothing: float
    accuracy: dict[float, float]


def fold_of(key: str, folds: int):
    """Fold number of a row; salted, so it is independent of the train/test bucket."""
    return md5_bucket(F.concat(F.col(key).cast("string"), F.lit("/fold")), folds)


def tune_naive_bayes(
    train: DataFrame,
    key: str,
    text: str = "tweet",
    sentiment: str = "sentiment",
    size: int = VOCABULARY_NB,
    grid: Sequence[float] = NB_SMOOTHING,
    folds: int = FOLDS,
) -> Tuned:
    """Naive Bayes with the smoothing that has the best mean accuracy (first on ties)."""
    tokens, counter, weigher, labels, bayes = models.nb_vocabulary(text, sentiment, size).getStages()
    label_model = labels.fit(train)
    rows = label_model.transform(tokens.transform(train.withColumn("fold", fold_of(key, folds).cast("int"))))
    rows = stored(rows.select("words", "label", "fold"), "words", ["fold"])
    counts = count_texts(rows, store=False)  # read once, for all models
    *partial, full = models_of(counts, counter, weigher, [*range(folds), None])

    def shares_of(fold: int) -> list[float | None]:
        """Per setting, the share of the fold's texts that a model without the fold names rightly."""
        fitted = partial[fold]
        held_out = PipelineModel(list(fitted.features)).transform(rows.filter(F.col("fold") == fold))
        held_out = held_out.select("features", "label")
        for i, smoothing in enumerate(grid):
            held_out = fitted.classifier(_setting(bayes, smoothing, f"prediction_{i}")).transform(held_out)
        hits = [F.avg((F.col(f"prediction_{i}") == F.col("label")).cast("double")) for i in range(len(grid))]
        return list(held_out.agg(*hits).first())

    with ThreadPoolExecutor(folds) as pool:  # folds wait for small jobs of their own
        per_fold = list(pool.map(shares_of, range(folds)))
    right = {smoothing: [shares[i] for shares in per_fold] for i, smoothing in enumerate(grid)}
    # A fold without texts has no accuracy and does not count.
    accuracy = {}
    for smoothing, shares in right.items():
        known = [s for s in shares if s is not None]
        accuracy[smoothing] = sum(known) / len(known) if known else 0.0
    best = max(grid, key=lambda smoothing: accuracy[smoothing])
    classifier = full.classifier(bayes.copy({bayes.smoothing: best}))
    return Tuned(PipelineModel([tokens, *full.features, label_model, classifier]), best, accuracy)


def _setting(bayes: NaiveBayes, smoothing: float, prediction: str) -> NaiveBayes:
    """A classifier that adds nothing but its prediction."""
    return bayes.copy(
        {
            bayes.smoothing: smoothing,
            bayes.predictionCol: prediction,
            bayes.rawPredictionCol: "",
            bayes.probabilityCol: "",
        }
    )
