"""The pipeline on the smallest tables, and the registered queries against their SQL."""

import pytest

import corpus_pipeline
from check import as_bag, connect
from textpulse.llm import QUERIES, SQL


def test_stages_filter_and_keep_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows, counts = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.store(stage(spark, rows, small), "test")
        assert rows.columns == docs.columns, name
        counts.append(rows.count())
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < docs.count()
    assert corpus_pipeline.run(spark, small).count() == counts[-1]


def test_stages_on_odd_rows(spark, small, odd_docs):
    rows = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, small)
    ids = {r["doc_id"] for r in rows.collect()}
    assert {3, 4, 5} <= ids and 2 not in ids


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    made = QUERIES[name](spark, folder)
    found = connect(folder).execute(SQL[name])
    columns = [d[0] for d in found.description]
    assert as_bag(made.columns, made.collect()) == as_bag(columns, found.fetchall())


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
