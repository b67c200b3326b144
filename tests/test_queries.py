"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as spark_entry
import check
from textpulse.schemas import SCORED_COLUMNS
from textpulse.suite import QUERIES, SQL

SF = "/root/testdata/sf0.001"
# Iterative or random fits over whole texts; ``check.py`` runs them on all rows.
SLOW = {"certify_lr_vocab", "train_lr_ngrams", "train_lr_hashed", "train_lr_vocab", "train_rf"}  # per row too costly here


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_equals_its_sql(spark, duck, name):
    ok, message = check.compare(spark, duck, name, SF, spark_entry.oracle_sql().get(name))
    assert ok, message


def test_every_library_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_every_sql_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_flagship(spark):
    df = spark_entry.entry(spark)
    assert tuple(df.columns) == SCORED_COLUMNS
    assert df.count() > 0
