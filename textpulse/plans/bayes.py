"""Naive Bayes on vocabulary tf-idf from one grouped count.

Everything that the vocabulary, the idf and the classifier learn is a sum over texts: how often
a term occurs in each class, in how many texts, and how many texts there are. So the texts are
read once, into counts per (fold, class, term). The model that leaves a fold out comes from
the total without that fold; the full model from the total.

The grouping is reduced in the map tasks, and everything after it works on one row per term,
class and fold. What reaches the JVM driver is the model: vocabulary size x classes.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import IDF, CountVectorizer, SQLTransformer, StringIndexer, Tokenizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.operators.terms import top_counts
from textpulse.plans.fitted import idf_model, in_order, vocabulary_model
from textpulse.session import stored


@dataclass(frozen=True)
class TextCounts:
    """Sufficient statistics of labelled texts.

    ``terms``: (fold, label, term, tf, df). ``texts``: (fold, label, number of texts), one
    entry per fold and class; the label is null for texts that only count in the features.
    """

    terms: DataFrame
    texts: tuple[tuple[int, float | None, int], ...]

    def classes(self, without: int | None = None) -> dict[float, int]:
        """Texts per class, without a fold."""
        found: dict[float, int] = {}
        for fold, label, n in self.texts:
            if fold != without and label is not None:
                found[label] = found.get(label, 0) + n
        return dict(sorted(found.items()))

    def total(self, without: int | None = None) -> int:
        return sum(n for fold, _, n in self.texts if fold != without)


def marked_words(words: Column) -> Column:
    """Every word with 1 at one of its occurrences in the array and 0 at the others."""
    ordered = F.sort_array(words)
    before = F.concat(F.array(F.lit(None).cast("string")), ordered)
    return F.zip_with(
        ordered,
        F.slice(before, 1, F.size(ordered)),
        lambda word, last: F.struct(word.alias("term"), (~word.eqNullSafe(last)).cast("int").alias("first")),
    )


def occurrences(words: Column) -> Column:
    """All words of the array, then each distinct one once more.

    Places in the first part count occurrences and those after it texts, with nothing to sort.
    """
    return F.concat(words, F.array_distinct(words))


def count_texts(rows: DataFrame, store: bool = True) -> TextCounts:
    """Counts of ``rows(words, label, fold)``: occurrences and texts from one pass.

    ``store=False`` leaves them a plan, for one call of ``models_of``, which reads them once.
    """
    words = F.col("words")
    tokens = rows.select("fold", "label", F.size(words).alias("n"), F.posexplode(occurrences(words)).alias("place", "term"))
    again = (F.col("place") >= F.col("n")).cast("long")
    grouped = tokens.groupBy("fold", "label", "term").agg(F.sum(1 - again).alias("tf"), F.sum(again).alias("df"))
    texts = rows.groupBy("fold", "label").agg(F.count("*").alias("n"))
    return TextCounts(stored(grouped, "term-counts") if store else grouped, tuple(map(tuple, texts.collect())))


@dataclass(frozen=True)
class Bayes:
    """Stages of the fitted features, and the class means that classifiers are made from."""

    features: tuple
    means: DataFrame

    def classifier(self, stage: NaiveBayes) -> NaiveBayesModel:
        """Spark's fit on one row per class: its mean vector, weighted by its texts."""
        return stage.copy({stage.weightCol: "weight"}).fit(self.means)


def models_of(
    counts: TextCounts, counter: CountVectorizer, weigher: IDF, without: Sequence[int | None] = (None,)
) -> list[Bayes]:
    """For each entry of ``without`` the features and class means of all other folds.

    All vocabularies are chosen in one job over the counts, one row per term and model, ties at
    the cap in term order. The files of the models are written side by side.
    """
    labels = list(counts.classes())
    entries = []
    for i, fold in enumerate(without):
        kept = F.lit(True) if fold is None else F.col("fold") != fold

        def total(value, also=F.lit(True), kept=kept):
            return F.coalesce(F.sum(F.when(kept & also, F.col(value))), F.lit(0))

        per_class = [total("tf", F.col("label") == label).cast("double") for label in labels]
        entries.append(
            F.struct(
                F.lit(i).alias("model"),
                total("tf").alias("n"),
                total("df").alias("df"),
                F.array(*per_class).alias("tf"),
            )
        )
    sums = counts.terms.groupBy("term").agg(F.array(*entries).alias("models"))
    sums = stored(sums.select("term", F.inline("models")).filter("n > 0"), "term-sums")
    texts = F.element_at(F.array(*(F.lit(counts.total(fold) + 1.0) for fold in without)), F.col("model") + 1)
    idf = F.log(texts / (F.col("df") + F.lit(1.0)))
    idf = F.when(F.col("df") >= weigher.getMinDocFreq(), idf).otherwise(0.0)
    top = top_counts(sums, counter.getVocabSize(), "model").withColumn("idf", idf)
    weighted = F.transform("tf", lambda t: t * F.col("idf"))
    top = stored(top.select("model", "index", "term", "idf", "df", weighted.alias("sums")), "vocabularies", ["model"])

    def vocabulary_of(i: int):
        return vocabulary_model(counter, in_order(top.filter(F.col("model") == i), "term", "vocabulary"))

    def weights_of(i: int):
        row = in_order(top.filter(F.col("model") == i), "struct(idf, df)", "w")
        texts = F.lit(counts.total(without[i])).cast("long").alias("numDocs")
        return idf_model(weigher, row.select(F.col("w.idf").alias("idf"), F.col("w.df").alias("docFreq"), texts))

    with ThreadPoolExecutor(2 * len(without)) as pool:  # each waits for a few small jobs
        vocabularies = pool.map(vocabulary_of, range(len(without)))
        weights = pool.map(weights_of, range(len(without)))
        features = list(zip(vocabularies, weights))
    return [
        Bayes(stages, _means(in_order(top.filter(F.col("model") == i), "sums", "sums"), counts, fold))
        for i, (stages, fold) in enumerate(zip(features, without))
    ]


def _means(row: DataFrame, counts: TextCounts, fold: int | None) -> DataFrame:
    """(label, weight, features) per class, from one row of ``sums`` per term and class."""
    present = counts.classes(fold)
    if not present:
        return row.selectExpr("0D AS label", "0D AS weight", "array(0D) AS mean").limit(0)
    classes = [_mean(k, label, present[label]) for k, label in enumerate(counts.classes()) if label in present]
    made = row.select(F.inline(F.array(*classes)))
    return made.select("label", "weight", array_to_vector("mean").alias("features"))


def _mean(k: int, label: float, texts: int) -> Column:
    """Class ``k``: its label, its texts, and its sums as the mean of a text."""
    weight = F.lit(float(texts))
    mean = F.transform("sums", lambda s: s[k] / weight)
    return F.struct(F.lit(label).alias("label"), weight.alias("weight"), mean.alias("mean"))


def fits_by_counts(stages: Sequence) -> bool:
    """Whether a pipeline is words, vocabulary, idf, labels and multinomial naive Bayes.

    A statement that cleans the texts may come first.
    """
    stages = stages[1:] if stages and isinstance(stages[0], SQLTransformer) else stages
    if [type(s) for s in stages] != [Tokenizer, CountVectorizer, IDF, StringIndexer, NaiveBayes]:
        return False
    _, counter, _, _, bayes = stages
    plain = not counter.getBinary() and counter.getMinDF() <= 1 and counter.getMinTF() <= 1
    return plain and bayes.getModelType() == "multinomial" and not bayes.isSet(bayes.weightCol)


def fit_by_counts(stages: Sequence, rows: DataFrame) -> PipelineModel:
    """The pipeline fitted from counts. Rows without a known label count in the features only."""
    *before, tokens, counter, weigher, labels, bayes = stages
    names = labels.fit(rows)
    made_words = PipelineModel([*before, tokens]).transform(rows)
    marked = names.copy().setHandleInvalid("keep").transform(made_words)
    known = F.when(F.col(labels.getOutputCol()) < len(names.labels), F.col(labels.getOutputCol()))
    counts = count_texts(
        marked.select(F.col(tokens.getOutputCol()).alias("words"), known.alias("label"), F.lit(0).alias("fold")),
        store=False,
    )
    (made,) = models_of(counts, counter, weigher)
    return PipelineModel([*before, tokens, *made.features, names, made.classifier(bayes)])
