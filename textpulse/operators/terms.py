"""Set forms of the text features: counts that Spark groups and shuffles by term.

The estimators (``CountVectorizer``, ``IDF``, ``StringIndexer``, ``ChiSqSelector``)
keep their answers inside a model. The same numbers as tables can be joined, stored
and checked. Every count is pre-aggregated in the map tasks, so a word that is a
third of all tokens costs one row per map task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpulse.operators.joins import lookup_join

#: Steps in which ``top_terms`` counts scores before it sorts the best.
STEPS = 4096


def label_index(df: DataFrame, label: str) -> DataFrame:
    """Class index per label: most frequent first, ties in alphabetical order.

    The ranking window is global, but it ranks one row per distinct label.
    """
    counts = (
        df.filter(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"))
        .agg(F.count("*").alias("n"))
    )
    order = Window.orderBy(F.col("n").desc(), F.col("label"))
    return counts.withColumn("index", (F.row_number().over(order) - 1).cast("double"))


def term_counts(df: DataFrame, words: Column) -> DataFrame:
    """Occurrences of every term, and the number of rows that hold it, in one shuffle."""
    per_row = df.select(F.explode(words).alias("term"))
    return per_row.groupBy("term").agg(F.count("*").alias("n"))


def vocabulary(df: DataFrame, words: Column, size: int) -> DataFrame:
    """The ``size`` most frequent terms and their rank; ties in term order.

    Terms below the count that the last kept term must have are filtered where they
    are, so the final sort sees little more than ``size`` rows.
    """
    return top_counts(term_counts(df, words), size)


def top_counts(counts: DataFrame, size: int, *of: str) -> DataFrame:
    """The ``size`` rows of ``counts(term, n, ...)`` with the largest ``n``, and their rank.

    ``of`` names the column whose values have a ranking each; without it there is one.
    """
    by = Window.partitionBy(*of)
    frequent = counts.join(F.broadcast(_least_counts(counts, size, *of)), list(of)) if of else counts.crossJoin(
        F.broadcast(_least_counts(counts, size))
    )
    # Little more than ``size`` rows are ranked.
    rank = F.row_number().over(by.orderBy(F.col("n").desc(), F.col("term"))) - 1
    ranked = frequent.filter(F.col("n") >= F.col("least")).drop("least").withColumn("index", rank)
    return ranked.filter(F.col("index") < size)


def _least_counts(counts: DataFrame, size: int, *of: str) -> DataFrame:
    """Per ranking, the smallest count with fewer than ``size`` terms above it: a row each.

    The running sum is over one row per distinct count.
    """
    histogram = counts.groupBy(*of, "n").agg(F.count("*").alias("terms"))
    above = F.sum("terms").over(Window.partitionBy(*of).orderBy(F.col("n").desc())) - F.col("terms")
    kept = histogram.withColumn("above", above).filter(F.col("above") < size)
    return kept.groupBy(*of).agg(F.min("n").alias("least"))


def document_frequency(df: DataFrame, words: Column) -> DataFrame:
    """Rows that hold the term. Repeats inside a row go first, so no distinct is needed."""
    return (
        df.select(F.explode(F.array_distinct(words)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def idf_weights(df: DataFrame, words: Column, min_doc_freq: int = 0) -> DataFrame:
    """``ln((m + 1) / (df + 1))`` per term, zero below ``min_doc_freq``."""
    rows = df.agg(F.count("*")).scalar()
    weight = F.log((rows + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    return document_frequency(df, words).withColumn(
        "idf", F.when(F.col("df") >= min_doc_freq, weight).otherwise(0.0)
    )


def chi_square_terms(df: DataFrame, words: Column, label: str) -> DataFrame:
    """Chi-square of (term is present) against the label, per term."""
    held = df.select(F.col(label).alias("label"), F.array_distinct(words).alias("term"))
    return presence_chi_square(held, "term", "label")


def presence_chi_square(df: DataFrame, held: str, label: str) -> DataFrame:
    """(``held``, df, chi_square) of every value in the arrays ``held``, each once per array.

    With N rows, N_l rows of label l, n_w rows with the value and n_wl of both, the
    statistic over the 2 x L table needs one sum per value, S = sum(n_wl^2 / N_l):
    N*S/n_w - n_w for the rows with the value plus N*(N - 2*n_w + S)/(N - n_w) -
    (N - n_w) for the rows without it. Zero counts add nothing to S, so only the
    pairs that occur are shuffled. Rows without a label are not counted.
    """
    labelled = df.filter(F.col(label).isNotNull())
    totals = labelled.groupBy(F.col(label).alias("_label")).agg(
        F.count("*").alias("_label_rows")
    )
    rows = labelled.agg(F.count("*")).scalar().cast("double")
    pairs = (
        labelled.select(F.col(label).alias("_label"), F.explode(held).alias(held))
        .groupBy(held, "_label")
        .agg(F.count("*").alias("_both"))
    )
    share = F.col("_both") * F.col("_both") / F.col("_label_rows")
    per_term = (
        lookup_join(pairs, totals, on=["_label"], spread_by=[held], how="inner")
        .groupBy(held)
        .agg(F.sum("_both").alias("df"), F.sum(share).alias("_s"))
        .withColumn("_n", rows)
    )
    n, with_it, s = F.col("_n"), F.col("df"), F.col("_s")
    statistic = F.when(
        with_it < n,
        (n * s / with_it - with_it)
        + (n * (n - 2 * with_it + s) / F.nullif(n - with_it, F.lit(0.0)) - (n - with_it)),
    ).otherwise(0.0)
    return per_term.select(held, "df", statistic.alias("chi_square"))


def top_terms(
    scores: DataFrame, score: str, size: int, ties: Sequence[str] = ("term",)
) -> DataFrame:
    """The ``size`` best terms by score, ties in the order given.

    Every task sorts its own terms and hands on ``size`` of them at most. Scores below the
    one that the last kept term must have go first, as a filter, when scores are counted in
    ``STEPS`` steps of their range, so little more than ``size`` rows meet in the last task.
    """
    bounds = scores.agg(F.min(score).alias("low"), F.max(score).alias("high"))
    low, high = F.col("low"), F.col("high")
    step = F.when(high > low, F.floor((F.col(score) - low) / (high - low) * STEPS)).otherwise(0)
    stepped = scores.crossJoin(F.broadcast(bounds)).withColumn("_step", step).drop("low", "high")
    counts = stepped.groupBy("_step").agg(F.count("*").alias("terms"))
    # At most STEPS + 1 rows are ranked.
    above = F.sum("terms").over(Window.orderBy(F.col("_step").desc())) - F.col("terms")
    least = counts.withColumn("above", above).filter(F.col("above") < size).agg(F.min("_step")).scalar()
    scores = stepped.filter(F.col("_step") >= least).drop("_step")
    return scores.orderBy(F.col(score).desc(), *ties).limit(size)
