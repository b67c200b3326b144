"""The committed sink and the log source: each row once, whatever is repeated or lost."""

import time

import pytest
from pyspark.sql import functions as F

from textpulse.session import new_folder
from textpulse.sources import replay_log
from textpulse.streaming import committed, scoring

ROWS = "id long, value string"
LOGGED = replay_log.SCHEMA


def numbers(spark, first, end):
    return spark.range(first, end).select("id", F.concat(F.lit("m"), "id").alias("value"))


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


def test_a_repeated_batch_is_stored_once(spark):
    out = new_folder(spark, "sink")
    write = committed.committed_writer(out, "s")
    for batch in (0, 1, 0, 1):
        write(numbers(spark, 10 * batch, 10 * batch + 10), batch)
    assert ids(committed.read_committed(spark, out, ROWS)) == list(range(20))


def test_a_crash_before_the_commit_leaves_nothing_to_read(spark, monkeypatch):
    out = new_folder(spark, "sink")
    write = committed.committed_writer(out, "s")
    write(numbers(spark, 0, 5), 0)
    with monkeypatch.context() as broken:
        broken.setattr(committed.CommitLog, "commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write(numbers(spark, 5, 10), 1)
    assert ids(committed.read_committed(spark, out, ROWS)) == list(range(5))
    write(numbers(spark, 5, 10), 1)
    assert ids(committed.read_committed(spark, out, ROWS)) == list(range(10))


def test_two_writers_of_one_batch(spark):
    out = new_folder(spark, "sink")
    log = committed.CommitLog(spark, out)
    log.commit("s", 0, "batches/a")
    with pytest.raises(Exception, match="FileAlreadyExists"):
        log.commit("s", 0, "batches/b")
    assert [e["folder"] for e in log.entries()] == ["batches/a"]


def test_an_empty_sink_reads_as_an_empty_table(spark):
    assert committed.read_committed(spark, new_folder(spark, "sink"), ROWS).count() == 0


def stream_of(spark, folder):
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(folder)


def test_a_new_checkpoint_replaces_no_batch(spark):
    out = new_folder(spark, "sink")
    for part in range(2):
        source = new_folder(spark, "in")
        numbers(spark, 10 * part, 10 * part + 10).repartition(3).write.parquet(source)
        scoring.drain(stream_of(spark, source), committed.committed_writer(out), new_folder(spark, "c"))
    assert ids(committed.read_committed(spark, out, ROWS)) == list(range(20))
    assert len({e["stream"] for e in committed.CommitLog(spark, out).entries()}) == 2


def log_of(spark, *ends):
    path, at = new_folder(spark, "log"), 0
    for end in ends:
        replay_log.append_log(numbers(spark, at, end), path, 3, "id")
        at = end
    return path


def test_offsets_go_on_from_the_last_append(spark):
    path = log_of(spark, 50, 80)
    out = new_folder(spark, "sink")
    write = committed.positioned_writer(out, "s")
    scoring.drain(replay_log.read_log_stream(spark, path), write, new_folder(spark, "c"))
    rows = committed.read_committed(spark, out, LOGGED).collect()
    assert sorted(int(r["value"][1:]) for r in rows) == list(range(80))
    for p in range(3):
        mine = sorted((r["offset"], int(r["value"][1:])) for r in rows if r["partition"] == p)
        assert [o for o, _ in mine] == list(range(len(mine)))
        assert [v for _, v in mine] == sorted(v for _, v in mine)


def test_a_new_checkpoint_stores_each_row_once(spark):
    """The source is read again from its beginning, in other batches; only new rows are stored."""
    path, out = log_of(spark, 40), new_folder(spark, "sink")
    write = committed.positioned_writer(out, "s")
    scoring.drain(replay_log.read_log_stream(spark, path), write, new_folder(spark, "c"))
    replay_log.append_log(numbers(spark, 40, 90), path, 3, "id")
    scoring.drain(replay_log.read_log_stream(spark, path), write, new_folder(spark, "c"))
    found = committed.read_committed(spark, out, LOGGED)
    assert ids(found.withColumn("id", F.expr("cast(substring(value, 2) AS long)"))) == list(range(90))
    scoring.drain(replay_log.read_log_stream(spark, path), write, new_folder(spark, "c"))
    assert committed.read_committed(spark, out, LOGGED).count() == 90


def test_a_crash_between_stage_and_commit_loses_no_position(spark, monkeypatch):
    path, out, checkpoint = log_of(spark, 30), new_folder(spark, "sink"), new_folder(spark, "c")
    write = committed.positioned_writer(out, "s")
    with monkeypatch.context() as broken:
        broken.setattr(committed.CommitLog, "commit", lambda *a, **k: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivision"):
            scoring.drain(replay_log.read_log_stream(spark, path), write, checkpoint)
    assert committed.read_committed(spark, out, LOGGED).count() == 0
    scoring.drain(replay_log.read_log_stream(spark, path), write, checkpoint)
    assert committed.read_committed(spark, out, LOGGED).count() == 30


def test_latest_skips_what_is_there_and_a_restart_loses_nothing(spark):
    path, out, checkpoint = log_of(spark, 30), new_folder(spark, "sink"), new_folder(spark, "c")

    def drain():
        stream = replay_log.read_log_stream(spark, path, replay_log.LATEST)
        scoring.drain(stream, committed.positioned_writer(out, "s"), checkpoint)

    drain()
    assert committed.read_committed(spark, out, LOGGED).count() == 0
    for end in (45, 60):  # appended while the query is down
        replay_log.append_log(numbers(spark, end - 15, end), path, 3, "id")
        drain()
        values = committed.read_committed(spark, out, LOGGED).collect()
        assert sorted(int(r["value"][1:]) for r in values) == list(range(30, end))


def test_paced_offsets(spark, monkeypatch):
    path = log_of(spark, 300)
    reader = replay_log.ReplayLogReader({"path": path, "startingOffsets": "earliest", "rowsPerSecond": "10"})
    began = reader._commits()[0]["at"]
    monkeypatch.setattr(time, "time", lambda: began + 2.55)
    assert reader.initialOffset() == {}
    assert reader.latestOffset() == {str(p): 25 for p in range(3)}
    ranges = reader.partitions({"0": 20}, reader.latestOffset())
    assert sorted((r.partition, r.first, r.end) for r in ranges) == [(0, 20, 25), (1, 0, 25), (2, 0, 25)]
    assert [row[1] for row in reader.read(ranges[0])] == list(range(ranges[0].first, ranges[0].end))
    monkeypatch.setattr(time, "time", lambda: began + 1e6)
    assert sum(reader.latestOffset().values()) == 300


def test_a_store_is_not_given_a_committed_batch_again(spark):
    store, log = new_folder(spark, "store"), new_folder(spark, "log")
    write = committed.store_writer("parquet", {"path": store}, log, "s")
    for batch in (0, 0, 1):
        write(numbers(spark, 10 * batch, 10 * batch + 10), batch)
    found = spark.read.parquet(store)
    assert ids(found) == list(range(20)) and ids(found.select("batch_id").distinct(), "batch_id") == [0, 1]
