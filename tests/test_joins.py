from collections import Counter

import pytest
from pyspark.sql import functions as F

from textpulse.operators import joins


def skewed(spark):
    """A third of the rows have one key, and some keys are not in the table."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    return spark.range(6000).select("id", key.alias("k")).repartition(6)


def table(spark):
    rows = [("hot", 1)] + [(f"k{i}", i) for i in range(0, 40, 2)]
    return spark.createDataFrame(rows, "k string, v int")


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_gives_the_plain_join(spark, how):
    rows, lookup = skewed(spark), table(spark)
    expected = Counter(map(tuple, rows.join(lookup, ["k"], how).collect()))
    salted = joins.lookup_join(rows, lookup, ["k"], ["id"], how, max_bytes=0)
    assert Counter(map(tuple, salted.select("k", "id", "v").collect())) == expected
    small = joins.lookup_join(rows, lookup, ["k"], ["id"], how)
    assert Counter(map(tuple, small.select("k", "id", "v").collect())) == expected
    assert "BroadcastHashJoin [k" in plan(small)


def test_hot_key_is_split_over_partitions(spark):
    rows = skewed(spark)
    salted = joins.salted_join(rows, table(spark), ["k"], ["id"], "inner")
    assert "_salt" in plan(salted) and salted.columns == ["k", "id", "v"]


def test_broadcast_limit_reads_units(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, expected in (("10MB", 10 << 20), ("2k", 2048), ("-1", -1), ("77b", 77)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert joins.broadcast_limit(spark) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_broadcasts_can_be_turned_off(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = joins.lookup_join(skewed(spark), table(spark), ["k"], ["id"])
        assert joined.count() == 6000 and "_salt" in plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_measured_bytes(spark):
    assert joins.measured_bytes(spark.createDataFrame([], "a int")) == 0
    assert joins.measured_bytes(spark.createDataFrame([("é",)], "a string")) == len('{"a":"é"}'.encode())
