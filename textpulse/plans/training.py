"""Fitting a text classifier so that iterations stay cheap and lost executors do no harm."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial
from math import ceil

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import CountVectorizer, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.functions import md5_bucket
from textpulse.operators.metrics import classification_report
from textpulse.operators.terms import vocabulary
from textpulse.plans import ordered
from textpulse.plans.bayes import fit_by_counts, fits_by_counts
from textpulse.plans.fitted import in_order, vocabulary_model
from textpulse.plans.runs import RunStages, fit_runs, inputs_of, run_stages
from textpulse.plans.scoring import score
from textpulse.session import new_folder, stored

BYTES_PER_ENTRY = 12  # one index and one weight of a sparse vector
BYTES_PER_GRADIENT = 8  # one class and feature
GRADIENTS_PER_PARTITION = 32
TREE_POWER = 2 / 3  # of partitions whose gradients meet in two steps, each of about the root of them
SHARE_STEPS = 1_000_000


def fit_stages(stages: Sequence, rows: DataFrame) -> tuple[list, DataFrame]:
    """(fitted stages, rows with their columns), in order.

    A vocabulary holds its stage's number of terms by count, ties in term order, so two
    fits of the same rows agree; the plain estimator leaves ties at the cap to chance.
    """
    fitted = []
    for stage in stages:
        if isinstance(stage, CountVectorizer):
            words, size = stage.getInputCol(), stage.getVocabSize()
            kept = vocabulary(rows, F.col(words), size)
            model = vocabulary_model(stage, in_order(kept, "term", "vocabulary"))
        else:
            model = Pipeline(stages=[stage]).fit(rows).stages[0]
        fitted.append(model)
        rows = model.transform(rows)
    return fitted, rows


def bounded_share(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows at most: a stable md5 share of the keys, the same on any layout."""
    n = rows.count()
    share = SHARE_STEPS if n <= most else most * SHARE_STEPS // n
    return rows.filter(md5_bucket(F.concat(F.col(key).cast("string"), F.lit("/fit")), SHARE_STEPS) < share)


#: Seconds that each call of ``fit_classifier`` took in this process, in order.
FIT_SECONDS: list[float] = []


def fit_classifier(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """``fitted`` with its time noted: training seconds apart from those of scoring."""
    began = time.perf_counter()
    model = fitted(pipeline, rows)
    FIT_SECONDS.append(time.perf_counter() - began)
    return model


@dataclass(frozen=True)
class Evaluation:
    """A fitted pipeline, the seconds its fit took, and the four metrics of held-out rows."""

    model: PipelineModel
    seconds: float
    report: DataFrame


def evaluate(pipeline: Pipeline, train: DataFrame, test: DataFrame) -> Evaluation:
    """Fit on ``train`` and report on ``test``.

    A label that the fit has not seen is left out or an error, as the pipeline's label stage says.
    """
    model = fit_classifier(pipeline, train)
    scored = score(model, test, labelled=True).select("label", "prediction")
    return Evaluation(model, FIT_SECONDS[-1], classification_report(scored))


def fitted(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """Fit the feature stages, store the features, then fit the last stage on them.

    Without the stored table every task of every iteration would carry the lineage:
    vocabularies and weights of all earlier stages. With it a task is small, and a
    lost executor costs a read, not a second run of the feature stages. Naive Bayes
    on vocabulary tf-idf is fitted from counts, see ``plans.bayes``; behind other features
    it reads its rows once, so it takes them as they come.
    """
    if fits_by_counts(pipeline.getStages()):
        return fit_by_counts(pipeline.getStages(), rows)
    *stages, classifier = pipeline.getStages()
    parts, hashed = run_stages(stages), ordered.hashes(stages, classifier)
    if parts is not None:
        made, prepared = _fit_run_stages(parts, rows)
    else:
        made, prepared = _fit_hashed_stages(stages, rows) if hashed else fit_stages(stages, rows)
    if hashed:
        return PipelineModel([*made, ordered.fit(classifier, made, prepared, partial(_pack, power=TREE_POWER))])
    if isinstance(classifier, NaiveBayes):
        model = classifier.fit(prepared.select("features", "label"))
        return PipelineModel([*made, model])
    spark = rows.sparkSession
    path = new_folder(spark, "features")
    prepared.select("features", "label").write.parquet(path)
    features = spark.read.parquet(path)
    if isinstance(classifier, LogisticRegression):
        features = _pack(features)
    return PipelineModel([*made, classifier.fit(features)])


def _fit_run_stages(parts: RunStages, rows: DataFrame) -> tuple[list, DataFrame]:
    """``fit_stages`` for a pipeline that counts word runs: texts are counted once, the other stages read the counts."""
    counters, counted = fit_runs(parts, rows)
    others, prepared = fit_stages([*(weigher for _, _, weigher in parts.runs), *parts.after], counted)
    made = list(parts.before)
    for (run, _, _), counter, weigher in zip(parts.runs, counters, others):
        made += [run, counter, weigher]
    return [*made, *others[len(parts.runs) :]], prepared


def _fit_hashed_stages(stages: Sequence, rows: DataFrame) -> tuple[list, DataFrame]:
    """``fit_stages`` with the counts stored as soon as the texts are hashed: idf, labels and features read those."""
    at = next(i for i, s in enumerate(stages) if isinstance(s, HashingTF)) + 1
    made, counted = fit_stages(stages[:at], rows)
    counts = stored(counted.select(*inputs_of(stages[at:], rows), stages[at - 1].getOutputCol()), "hashed-counts")
    others, prepared = fit_stages(stages[at:], counts)
    return [*made, *others], prepared


def _pack(rows: DataFrame, power: float = 1 / 2) -> DataFrame:
    """As many partitions as the root of the data's bytes in gradients, or more.

    Every partition sends a gradient of classes x features in every iteration, so it should
    hold more data than that, the more the more of them there are: with the root, reading a
    partition and adding up the gradients of all grow alike. None holds more than
    ``GRADIENTS_PER_PARTITION`` times a gradient. ``power`` is that of the root, or of another law. The number follows from the features alone, not
    from the cluster; it decides the order of sums, so the last digits of the weights.
    """
    first = rows.select(F.size(vector_to_array("features")).alias("width")).first()
    if first is None:
        return rows
    sizes = rows.select(F.size(F.unwrap_udt("features")["values"]).alias("entries"), "label")
    entries, top = sizes.agg(F.sum(F.greatest("entries", F.lit(0))), F.max("label")).first()
    gradient = first["width"] * (int(top) + 1) * BYTES_PER_GRADIENT
    held = (entries or 0) * BYTES_PER_ENTRY / gradient
    return rows.coalesce(max(1, ceil(held**power), ceil(held / GRADIENTS_PER_PARTITION)))
