"""Naive Bayes from grouped counts against Spark's own pipeline on the same rows."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from textpulse.plans import bayes, models, training, tuning
from textpulse.plans.bayes import count_texts, fit_by_counts, fits_by_counts, marked_words
from textpulse.plans.training import fit_classifier


def frame(spark, data, partitions=3):
    return spark.createDataFrame(data, "id long, sentiment string, tweet string").repartition(partitions, "id")


ODD = [
    (1, "x", "a b b c"), (2, "x", "a a d"), (3, "y", "c d d e"), (4, "y", "e"), (5, None, "f f f a"),
    (6, "z", ""), (7, "y", " g  a "), (8, "x", "a b b c"),
]


def test_marked_words_count_a_text_once(spark):
    df = spark.createDataFrame([(["b", "a", "b", "", "b"],), ([],), (["a"],)], "w array<string>")
    found = df.select(F.inline(marked_words(F.col("w")))).groupBy("term").agg(F.count("*"), F.sum("first")).collect()
    assert {tuple(r) for r in found} == {("", 1, 1), ("a", 2, 2), ("b", 3, 1)}


@pytest.mark.parametrize("size, smoothing, partitions", [(100, 1.0, 1), (100, 0.5, 4), (3, 1.0, 2)])
def test_counts_give_the_model_of_the_plain_pipeline(spark, size, smoothing, partitions):
    """Texts without a label count in the vocabulary and the idf, but in no class."""
    rows = frame(spark, ODD, partitions)
    pipeline = models.nb_vocabulary(size=size, smoothing=smoothing)
    ours = fit_classifier(pipeline, rows)
    assert [type(s) for s in ours.stages] == [type(s) for s in pipeline.fit(rows).stages]
    vocabulary = ours.stages[1].vocabulary
    if size == 3:
        assert vocabulary == ["a", "b", ""]  # a 7, b 4; then the empty word, d and f with 3, by term
        return
    theirs = pipeline.fit(rows)
    order = [theirs.stages[1].vocabulary.index(t) for t in vocabulary]
    assert sorted(order) == list(range(len(theirs.stages[1].vocabulary)))
    assert ours.stages[2].idf.toArray().tolist() == pytest.approx(theirs.stages[2].idf.toArray()[order].tolist())
    assert ours.stages[2].docFreq == [theirs.stages[2].docFreq[i] for i in order]
    assert ours.stages[2].numDocs == theirs.stages[2].numDocs == 8
    assert ours.stages[4].pi.toArray().tolist() == pytest.approx(theirs.stages[4].pi.toArray().tolist())
    assert ours.stages[4].theta.toArray() == pytest.approx(theirs.stages[4].theta.toArray()[:, order])


def test_rare_words_weigh_nothing(spark):
    rows = frame(spark, ODD)
    tokens, counter, weigher, labels, bayes = models.nb_vocabulary().getStages()
    stages = [tokens, counter, weigher.setMinDocFreq(2), labels, bayes]
    ours, theirs = fit_by_counts(stages, rows), Pipeline(stages=stages).fit(rows)
    weights = [dict(zip(m.stages[1].vocabulary, m.stages[2].idf.toArray())) for m in (ours, theirs)]
    assert weights[0] == pytest.approx(weights[1]) and weights[0]["g"] == 0


def test_only_the_known_pipeline_is_counted():
    stages = models.nb_vocabulary().getStages()
    assert fits_by_counts(stages)
    assert not fits_by_counts([*stages[:1], stages[1].copy().setBinary(True), *stages[2:]])
    assert not fits_by_counts([*stages[:4], stages[4].copy().setModelType("complement")])
    assert not fits_by_counts(models.lr_vocabulary().getStages())


def test_counts_without_a_fold(spark):
    rows = spark.createDataFrame(
        [(["a", "a"], 0.0, 0), (["a", "b"], 1.0, 1), (["b"], None, 1), (["c"], 2.0, 2)],
        "words array<string>, label double, fold int",
    )
    counts = count_texts(rows)
    assert counts.classes() == {0.0: 1, 1.0: 1, 2.0: 1} and counts.classes(2) == {0.0: 1, 1.0: 1}
    assert (counts.total(), counts.total(1)) == (4, 2)
    found = {tuple(r) for r in counts.terms.select("fold", "label", "term", "tf", "df").collect()}
    assert found == {(0, 0.0, "a", 2, 1), (1, 1.0, "a", 1, 1), (1, 1.0, "b", 1, 1), (1, None, "b", 1, 1), (2, 2.0, "c", 1, 1)}


def test_tuning_with_a_class_in_one_fold_only(spark):
    data = [(i, "xy"[i % 2], "a b c d".split()[i % 4] + " " + "uv"[i % 2]) for i in range(60)] + [(99, "rare", "q")]
    tuned = tuning.tune_naive_bayes(frame(spark, data), "id")
    assert tuned.accuracy[tuned.smoothing] > 0.9
    assert tuned.model.transform(frame(spark, data[-1:])).count() == 1


def test_no_word_passes_through_the_driver(spark, monkeypatch):
    """The vocabulary goes by files; no job brings terms to Python."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen = []
    plain = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(plain(self)) or seen[-1])
    fit_classifier(models.nb_vocabulary(), frame(spark, ODD))
    assert not any("b" in map(str, r) for rows in seen for r in rows)


def test_fit_seconds_are_noted(spark):
    before = len(training.FIT_SECONDS)
    fit_classifier(models.nb_vocabulary(), frame(spark, ODD))
    assert len(training.FIT_SECONDS) == before + 1 and training.FIT_SECONDS[-1] > 0


def test_counting_words_sorts_nothing_and_stores_no_counts(spark, monkeypatch):
    """A text's words are hashed, not ordered, and the counts of a tuning are read once, so not written."""
    rows = spark.createDataFrame(
        [(["b", "a", "b", "", "b"], 0.0, 0), ([], 0.0, 0), (None, 0.0, 0), (["a"], 0.0, 0)], "words array<string>, label double, fold int"
    )
    terms = count_texts(rows, store=False).terms
    plan = terms._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" not in plan and "lambda" not in plan
    assert {tuple(r) for r in terms.select("term", "tf", "df").collect()} == {("", 1, 1), ("a", 2, 2), ("b", 3, 1)}
    written = []
    plain = bayes.stored
    monkeypatch.setattr(bayes, "stored", lambda df, name, *by: written.append(name) or plain(df, name, *by))
    tuning.tune_naive_bayes(frame(spark, [(i, "xy"[i % 2], f"a {'uv'[i % 2]}") for i in range(30)]), "id")
    assert written == ["term-sums", "vocabularies"]
