import math

from pyspark.ml.feature import IDF, CountVectorizer, StringIndexer
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from textpulse.functions import lower_words
from textpulse.operators import terms

SF = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "lang", lower_words(F.col("text")).alias("words")
    )


def test_label_order(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "c", "c", None]], "s string")
    rows = terms.label_index(df, "s").orderBy("index").collect()
    assert [r["label"] for r in rows] == ["c", "a", "b"]
    assert StringIndexer(inputCol="s", handleInvalid="skip").fit(df).labels == ["c", "a", "b"]


def test_idf_of_the_literal_texts(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],), (["c"],)], "w array<string>")
    got = {r["term"]: r["idf"] for r in terms.idf_weights(df, F.col("w")).collect()}
    assert {k: round(v, 6) for k, v in got.items()} == {"a": 0.287682, "b": 0.693147, "c": 0.693147}
    cut = {r["term"]: r["idf"] for r in terms.idf_weights(df, F.col("w"), 2).collect()}
    assert cut["b"] == cut["c"] == 0.0 and cut["a"] > 0


def test_idf_equals_the_estimator(spark):
    df = documents(spark)
    counts = CountVectorizer(inputCol="words", outputCol="tf").fit(df)
    model = IDF(inputCol="tf", outputCol="x", minDocFreq=5).fit(counts.transform(df))
    expected = dict(zip(counts.vocabulary, model.idf.toArray(), strict=True))
    got = {r["term"]: r["idf"] for r in terms.idf_weights(df, F.col("words"), 5).collect()}
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[t], expected[t], rel_tol=1e-12) for t in got)


def test_vocabulary_equals_the_estimator_up_to_ties(spark):
    df = documents(spark)
    size = 500
    rows = terms.vocabulary(df, F.col("words"), size).orderBy("index").collect()
    counts = {r["term"]: r["n"] for r in terms.term_counts(df, F.col("words")).collect()}
    brute = sorted(counts, key=lambda t: (-counts[t], t))[:size]
    assert [r["term"] for r in rows] == brute
    assert [r["index"] for r in rows] == list(range(size))
    theirs = CountVectorizer(inputCol="words", vocabSize=size).fit(df).vocabulary
    assert [counts[t] for t in theirs] == [counts[t] for t in brute]


def test_vocabulary_larger_than_the_terms(spark):
    df = spark.createDataFrame([(["a", "b", "a"],)], "w array<string>")
    rows = terms.vocabulary(df, F.col("w"), 10).orderBy("index").collect()
    assert [(r["term"], r["n"]) for r in rows] == [("a", 2), ("b", 1)]


def test_chi_square_equals_the_test_on_presence(spark):
    texts = [("x", "a b"), ("x", "a"), ("y", "b c"), ("y", "c"), ("z", "a c"), ("z", "c b"), ("x", "d")]
    df = spark.createDataFrame([(s, t.split()) for s, t in texts], "s string, w array<string>")
    got = {r["term"]: r["chi_square"] for r in terms.chi_square_terms(df, F.col("w"), "s").collect()}
    vocabulary = sorted(got)
    labels = {"x": 0.0, "y": 1.0, "z": 2.0}
    rows = [
        (labels[s], Vectors.dense([float(w in t.split()) for w in vocabulary])) for s, t in texts
    ]
    test = ChiSquareTest.test(spark.createDataFrame(rows, ["label", "features"]), "features", "label")
    expected = test.first()["statistics"].toArray()
    for term, value in zip(vocabulary, expected, strict=True):
        assert math.isclose(got[term], value, rel_tol=1e-9), term


def test_a_term_of_every_row_has_no_relevance(spark):
    df = spark.createDataFrame([("x", ["a"]), ("y", ["a"])], "s string, w array<string>")
    assert terms.chi_square_terms(df, F.col("w"), "s").first()["chi_square"] == 0.0


def test_top_terms_filters_before_it_sorts(spark):
    scores = spark.range(5000).select(F.concat(F.lit("t"), F.col("id")).alias("term"), (F.col("id") % 700).cast("double").alias("s"))
    got = [tuple(r) for r in terms.top_terms(scores, "s", 20).collect()]
    assert got == sorted(map(tuple, scores.collect()), key=lambda r: (-r[1], r[0]))[:20]
    flat = scores.withColumn("s", F.lit(1.0))
    assert [r["term"] for r in terms.top_terms(flat, "s", 3).collect()] == ["t0", "t1", "t10"]
