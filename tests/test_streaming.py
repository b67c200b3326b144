import json

import pytest
from pyspark.sql.types import LongType

from textpulse.plans import models
from textpulse.plans.scoring import score
from textpulse.plans.training import fit_classifier
from textpulse.schemas import SCORED_COLUMNS, tweet_schema
from textpulse.session import new_folder
from textpulse.sources.messages import decode_messages, encode_messages
from textpulse.sources.writers import load_model, save_model
from textpulse.streaming import replay, scoring

SCHEMA = tweet_schema(LongType())


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (i, f"g{i % 3}", "up" if i % 2 else "down", None if i % 10 == 9 else f"{'Good!' if i % 2 else 'bad'} t{i % 5}\n\"x\"")
        for i in range(50)
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def model(rows):
    return fit_classifier(models.nb_vocabulary(clean=True), rows.dropna())


def folders(spark):
    return [new_folder(spark, n) for n in ("in", "out", "checkpoint")]


def contents(spark, out, schema):
    return sorted(map(tuple, scoring.read_scored(spark, out, schema).select(*SCORED_COLUMNS).collect()))


def test_stream_equals_batch(spark, rows, model):
    source, out, checkpoint = folders(spark)
    replay.write_replay(rows, source, files=6)
    scored = scoring.score_messages(replay.replay_stream(spark, source, 2), model, SCHEMA)
    scoring.drain(scored, scoring.folder_writer(out), checkpoint)
    batch = scoring.score_messages(encode_messages(rows), model, SCHEMA)
    expected = sorted(map(tuple, batch.collect()))
    assert len(expected) == 45
    assert contents(spark, out, scored.schema) == expected
    # Two files per trigger: three batches.
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 3


def test_a_repeated_batch_changes_nothing(spark, rows, tmp_path):
    out = str(tmp_path / "out")
    write = scoring.folder_writer(out)
    for _ in range(2):
        write(rows, 0)
        write(rows, 1)
    assert spark.read.parquet(out).count() == 100


def test_restart_continues_from_the_checkpoint(spark, rows, model):
    source, out, checkpoint = folders(spark)
    first, second = rows.filter("id < 20"), rows.filter("id >= 20")
    scored = None
    for part in (first, second):
        encode_messages(part).write.mode("append").text(source)
        stream = replay.replay_stream(spark, source, 100)
        scored = scoring.score_messages(stream, model, SCHEMA)
        scoring.drain(scored, scoring.folder_writer(out), checkpoint)
    batch = scoring.score_messages(encode_messages(rows), model, SCHEMA)
    assert contents(spark, out, scored.schema) == sorted(map(tuple, batch.collect()))


def test_bad_messages_do_not_stop_the_stream(spark, model):
    source, out, checkpoint = folders(spark)
    lines = ["{bad", json.dumps({"id": 1, "game": "g", "sentiment": "up", "tweet": "good"}), ""]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(source)
    scored = scoring.score_messages(replay.replay_stream(spark, source), model, SCHEMA)
    scoring.drain(scored, scoring.folder_writer(out, echo=True), checkpoint)
    assert [r[0] for r in contents(spark, out, scored.schema)] == [1]


def test_labelled_stream_drops_unseen_labels(spark, model):
    messages = [{"id": i, "game": "g", "sentiment": s, "tweet": "good"} for i, s in enumerate(["up", "zz"])]
    df = spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")
    scored = scoring.score_messages(df, model, SCHEMA, labelled=True)
    assert [r["id"] for r in scored.collect()] == [0]
    named = scoring.score_messages(df, model, SCHEMA, names="stream")
    assert named.count() == 2


def test_a_model_decides_whether_texts_are_cleaned(spark, rows, model):
    message = json.dumps({"id": 1, "game": "g", "sentiment": "up", "tweet": "Good!"})
    df = spark.createDataFrame([(message,)], "value string")
    raw = fit_classifier(models.nb_vocabulary(), rows.dropna())
    assert scoring.score_messages(df, model, SCHEMA).first()["tweet"] == "good"
    assert scoring.score_messages(df, raw, SCHEMA).first()["tweet"] == "Good!"
    path = new_folder(spark, "cleaning")
    save_model(model, path)
    again = load_model(path)
    assert models.cleans(again) and not models.cleans(raw)
    assert score(again, rows.limit(1)).first()["words"] == ["bad", "t0", "x"]


def test_running_query_can_be_stopped(spark, rows, model):
    source, out, checkpoint = folders(spark)
    replay.write_replay(rows, source, files=1)
    scored = scoring.score_messages(replay.replay_stream(spark, source), model, SCHEMA)
    running = scoring.start(scored, scoring.folder_writer(out), checkpoint, every="1 second")
    running.processAllAvailable()
    assert running.isActive
    running.stop()
    assert len(contents(spark, out, scored.schema)) == 45


def test_replayed_rows_decode_to_themselves(spark, rows):
    source, _, _ = folders(spark)
    replay.write_replay(rows, source)
    back = decode_messages(spark.read.text(source), SCHEMA)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
