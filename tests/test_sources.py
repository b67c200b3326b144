import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from textpulse.schemas import tweet_schema
from textpulse.session import new_folder, shared_dir
from textpulse.sources import messages, readers, writers


def decode(spark, *values):
    return messages.decode_messages(spark.createDataFrame([(v,) for v in values], "value string"))


GOOD = {"id": 1, "game": "g", "sentiment": "s", "tweet": "t"}


def test_bad_and_null_messages_drop(spark):
    rows = decode(spark, "{bad", None, json.dumps(GOOD)).dropna().collect()
    assert [r.asDict() for r in rows] == [GOOD]


@pytest.mark.parametrize("bad", ["x", 3000000000])
def test_wrong_id_drops_the_row(spark, bad):
    df = decode(spark, json.dumps({**GOOD, "id": bad}))
    assert df.first()["id"] is None
    assert df.dropna().count() == 0


def test_wide_id_with_a_wider_schema(spark):
    df = spark.createDataFrame([(json.dumps({**GOOD, "id": 3000000000}),)], "value string")
    assert messages.decode_messages(df, tweet_schema(LongType())).first()["id"] == 3000000000


def test_extra_key_and_numeric_text(spark):
    row = decode(spark, json.dumps({**GOOD, "tweet": 12.5, "extra": [1]})).first()
    assert row["tweet"] == "12.5"
    assert set(row.asDict()) == set(GOOD)


def test_bytes_values_decode(spark):
    df = spark.createDataFrame([(bytearray(json.dumps(GOOD), "utf-8"),)], "value binary")
    assert messages.decode_messages(df).first().asDict() == GOOD


def test_null_text_is_left_out_and_dropped(spark):
    rows = spark.createDataFrame([(1, "g", "s", None)], tweet_schema())
    sent = messages.encode_messages(rows)
    assert "tweet" not in json.loads(sent.first()["value"])
    assert messages.decode_messages(sent).dropna().count() == 0


def test_bare_nan_is_text(spark):
    text = '{"id":1,"game":"g","sentiment":"s","tweet":NaN}'
    assert decode(spark, text).first()["tweet"] == '"NaN"'


def test_corrupt_messages_are_kept_apart(spark):
    df = spark.createDataFrame([("{bad",), (None,), (json.dumps(GOOD),)], "value string")
    good, bad = messages.split_corrupt(df)
    assert [r.asDict() for r in good.collect()] == [GOOD]
    assert sorted(str(r["value"]) for r in bad.collect()) == ["None", "{bad"]


def csv(spark, tmp_path, text, reader, **options):
    path = tmp_path / "in.csv"
    path.write_text(text, encoding="utf-8")
    return reader(spark, str(path), **options).collect()


def test_csv_quotes_commas_and_newlines(spark, tmp_path):
    text = '1,g,Positive,"he said ""hi"", ok"\n2,g,Neutral,"two\nlines"\n3,g,NA,NA\n'
    rows = csv(spark, tmp_path, text, readers.read_tweet_csv)
    assert [r["tweet"] for r in rows] == ['he said "hi", ok', "two\nlines", "NA"]
    assert rows[2]["sentiment"] == "NA"


def test_csv_wrong_id_is_null(spark, tmp_path):
    rows = csv(spark, tmp_path, "x,g,s,t\n", readers.read_tweet_csv)
    assert rows[0]["id"] is None and rows[0]["tweet"] == "t"


def test_headered_csv(spark, tmp_path):
    rows = csv(spark, tmp_path, 'tweet,label\n"a ""b""",positive\n', readers.read_labelled_csv)
    assert [tuple(r) for r in rows] == [('a "b"', "positive")]


def test_many_texts(spark):
    assert readers.texts_to_frame(spark, ["a", "b"]).count() == 2


def test_served_records_take_either_name(spark):
    rows = [
        ("1", datetime(2024, 1, 1), "t", 0.0, "negative", None),
        ("2", None, "u", 1.0, None, "positive"),
    ]
    df = spark.createDataFrame(
        rows,
        "_id string, timestamp timestamp_ntz, tweet string, prediction double, "
        "sentiment string, sentiment_prediction string",
    )
    got = [tuple(r) for r in readers.serve_records(df).orderBy("_id").collect()]
    assert got == [
        ("1", "2024-01-01T00:00:00.000000", "t", 0.0, "negative"),
        ("2", None, "u", 1.0, "positive"),
    ]
    scored_only = df.drop("timestamp", "sentiment")
    assert readers.serve_records(scored_only).filter("timestamp IS NULL").count() == 2


def test_summary_file_has_its_header(spark, tmp_path):
    summary = spark.createDataFrame([("f", 2, "positive")], "a string, b long, c string")
    path = str(tmp_path / "summary")
    writers.write_summary(summary, path)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines == ['"Frame","Count","Sentiment"', '"f","2","positive"']


def test_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    scored = spark.createDataFrame([("t", 1.0, "positive")], "tweet string, prediction double, sentiment string")
    for _ in range(2):
        writers.append_log(writers.scored_log(scored), path)
    back = spark.read.parquet(path)
    assert back.columns == ["timestamp", "tweet", "prediction", "sentiment"]
    assert back.filter(F.col("timestamp").isNotNull()).count() == 2


def test_kafka_options():
    options = messages.kafka_options("h:1", "t", max_per_trigger=5)
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5",
    }


def test_shared_dir_prefers_the_setting(spark):
    class Conf:
        @staticmethod
        def get(key, default=None):
            return "/shared/spark/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf

    assert shared_dir(Session) == "/shared/spark"
    assert new_folder(Session, "x").startswith("/shared/spark/x-")


def test_a_cluster_without_the_setting_is_an_error():
    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        conf = Conf

        class sparkContext:
            master = "yarn"
            applicationId = "app"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session)


def test_log_of_a_labelled_frame(spark):
    scored = spark.createDataFrame([("a", "x", 1.0, "y")], "tweet string, sentiment string, prediction double, sentiment_prediction string")
    row = writers.scored_log(scored, "sentiment_prediction").first()
    assert (row["tweet"], row["prediction"], row["sentiment"]) == ("a", 1.0, "y") and row["timestamp"] is not None
