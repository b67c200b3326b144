import pytest
from pyspark.sql import functions as F

from textpulse.operators import clean
from textpulse.operators.partitions import spread_rows
from textpulse.schemas import tweet_schema


def test_cleaned_to_empty_stays(spark):
    df = spark.createDataFrame([(1, "g", "s", "!!!"), (2, "g", "s", None)], tweet_schema())
    assert [tuple(r) for r in clean.clean_tweets(df).collect()] == [(1, "g", "s", "")]


def test_both_null_rules(spark):
    df = spark.createDataFrame([(1, None, "s", "a"), (2, "g", "s", None)], tweet_schema())
    assert clean.drop_incomplete(df).count() == 0
    assert [r["id"] for r in clean.drop_incomplete(df, ["tweet"]).collect()] == [1]


def test_min_words_drops_nulls(spark):
    df = spark.createDataFrame([("a b",), ("a",), (None,)], "tweet string")
    assert [r["tweet"] for r in clean.keep_min_words(df).collect()] == ["a b"]


def test_empty_texts_are_split_off(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "tweet string")
    accepted, rejected = clean.split_empty(df)
    assert [r["tweet"] for r in accepted.collect()] == ["a"]
    assert rejected.count() == 2


def test_one_row_per_text_with_a_hot_text(spark):
    ids = spark.range(3000).withColumn("id", F.col("id").cast("int"))
    df = ids.select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("tweet"),
        (F.col("id") * 2).alias("other"),
    ).repartition(7)
    rows = df.collect()
    smallest = {}
    for row in sorted(rows, key=lambda r: r["id"]):
        smallest.setdefault(row["tweet"], tuple(row))
    got = clean.drop_repeated_text(df, "tweet", "id")
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == sorted(smallest.values())


def test_split_does_not_depend_on_partitions(spark):
    ids = spark.range(1000)
    parts = [
        {r["id"] for r in clean.stable_split(ids.repartition(n), "id")[0].collect()} for n in (1, 5)
    ]
    assert parts[0] == parts[1]
    assert 700 < len(parts[0]) < 900
    train, test = clean.stable_split(ids, "id")
    assert train.count() + test.count() == 1000


def test_random_split_is_offered(spark):
    train, test = clean.random_split(spark.range(100))
    assert train.count() + test.count() == 100


def test_rows_are_spread_only_when_too_few_partitions(spark):
    few = spark.range(100, numPartitions=1)
    spread = spread_rows(few, "id")
    assert spread.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(r["id"] for r in spread.collect()) == list(range(100))
    many = spark.range(100, numPartitions=50)
    assert spread_rows(many, "id") is many
    assert spread_rows(few, "id", store=True).count() == 100


def test_unknown_columns_are_an_error(spark):
    df = spark.createDataFrame([(1, "a")], "id int, tweet string")
    with pytest.raises(ValueError, match="typo"):
        clean.drop_incomplete(df, ["tweet", "typo"])
    assert clean.drop_incomplete(df, []).count() == 1


def test_repeated_texts_are_found_by_a_hash_aggregate(spark):
    df = spark.createDataFrame([(2, "a"), (1, "a"), (None, None), (3, None), (None, "z")], "id int, tweet string")
    kept = clean.drop_repeated_text(df, "tweet", "id")
    assert {tuple(r) for r in kept.collect()} == {(1, "a"), (3, None), (None, "z")}
    assert "SortAggregate" not in kept._jdf.queryExecution().executedPlan().toString()
