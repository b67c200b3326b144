import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from textpulse.plans import models, runs, training

TEXTS = [
    "a b a b c", "", " a  b", "\t", "a", "B a\tb", "é ü é ü ß", "c  ", "İ Σ ΑΣ x", "a b c d e f g h", "日本 語 日本 語", "a b " * 40,
]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, "xy"[i % 2], TEXTS[i % len(TEXTS)]) for i in range(60)]
    return spark.createDataFrame(data, "id long, sentiment string, tweet string").repartition(3, "id")


def stages_of(size, binary=False, min_doc_freq=2):
    made = models.ngram_stages(3, size, min_doc_freq, binary=binary)
    return [*models.text_stages("tweet", False), *made, models.label_stage("sentiment", "error")]


@pytest.mark.parametrize("size, binary, chunk_bytes", [(5, False, 40), (1000, True, 1), (1000, False, 1 << 18)])
def test_runs_are_counted_as_the_stages_count_them(rows, monkeypatch, size, binary, chunk_bytes):
    monkeypatch.setattr(runs, "CHUNK_BYTES", chunk_bytes)
    stages = stages_of(size, binary)
    plain, expected = training.fit_stages(stages, rows)
    made, found = training._fit_run_stages(runs.run_stages(stages), rows)
    assert [m.vocabulary for m in made if hasattr(m, "vocabulary")] == [m.vocabulary for m in plain if hasattr(m, "vocabulary")]
    assert [type(m) for m in made] == [type(m) for m in plain]
    columns = ["1_tf", "2_tf", "3_tf", "rawFeatures", "label"]
    bags = [sorted(str(tuple(r)) for r in df.select(*columns).collect()) for df in (found, expected)]
    assert bags[0] == bags[1]
    scored = runs.transform(PipelineModel(made), rows, ["id", *columns])
    assert sorted(map(str, scored.collect())) == sorted(map(str, PipelineModel(plain).transform(rows).select("id", *columns).collect()))


def test_a_vocabulary_rarer_than_its_bound_is_counted_again(spark, monkeypatch):
    """All words of a bucket: its count says nothing of the last term's, so a second bound has to be taken."""
    monkeypatch.setattr(runs, "BUCKETS_PER_TERM", 1)
    monkeypatch.setattr(runs, "BUCKETS_PER_ROW", 8)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i : i + 7]) for i in range(394)] + ["w3 w9 w3 w9"] * 3
    rows = spark.createDataFrame([(t,) for t in texts], "tweet string").repartition(3)
    split = rows.select(F.split("tweet", " ").alias("words"))
    joined = split.select(*runs.joined_words("words"))
    top = runs.top_runs(joined, {1: 6, 2: 9})
    for n, size in ((1, 6), (2, 9)):
        every = rows.select(F.explode(F.transform(F.sequence(F.lit(0), F.size(F.split("tweet", " ")) - n), lambda i: F.array_join(F.slice(F.split("tweet", " "), i + 1, n), " "))).alias("term"))
        expected = every.groupBy("term").count().orderBy(F.col("count").desc(), "term").limit(size).collect()
        got = top.filter(F.col("run") == n).orderBy("index").collect()
        assert [(r["term"], r["n"]) for r in got] == [(r["term"], r["count"]) for r in expected]


def test_texts_are_counted_once_for_all_stages(rows):
    """Later stages read counts: no plan after the vectors makes words or runs again."""
    _, found = training._fit_run_stages(runs.run_stages(stages_of(50)), rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "tweet" not in plan and "words" not in plan


def test_runs_tell_word_order_and_bounds_apart():
    data = np.frombuffer(b"a bb" + b"bb a", np.uint8)
    part = runs.chunk(data, np.array([0, 4, 8]), np.array([2, 2]))
    found = {n: (first.tolist(), hashes) for n, first, hashes in part.runs(3)}
    assert found[1][0] == [0, 1, 2, 3] and found[2][0] == [0, 2] and found[3][0] == []
    one, two = found[1][1], found[2][1]
    assert one[0] == one[3] and one[1] == one[2] != one[0] and two[0] != two[1]
    assert part.strings(2, np.array([0, 2])) == [b"a bb", b"bb a"]


def test_other_pipelines_keep_their_stages():
    assert runs.run_stages(models.lr_hashed().getStages()) is None
    assert runs.run_stages(models.lr_vocabulary().getStages()) is None
    stages = models.lr_ngrams(clean=True).getStages()
    parts = runs.run_stages(stages)
    assert [run.getN() for run, _, _ in parts.runs] == [1, 2, 3] and len(parts.before) == 2
    assert [*parts.before, *(s for run in parts.runs for s in run), *parts.after] == stages
    stages[3].setMinTF(2.0)
    assert runs.run_stages(stages) is None
    assert isinstance(Pipeline(stages=stages), Pipeline)
