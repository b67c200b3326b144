import random

import pytest
from pyspark.sql import functions as F

from textpulse.operators import joins
from textpulse.operators.lexicon import (
    first_frames,
    first_senses,
    frame_keys,
    most_frequent_tag,
)
from textpulse.plans import semantics

SENSES = "lemma string, pos string, rank int, definition string, synonyms array<string>, hypernyms array<string>, hyponyms array<string>"
FRAMES = "frame_rank int, frame_name string, frame_definition string, frame_elements array<string>, lu_name string"


def senses(spark):
    rows = [
        ("run", "v", 2, "move fast", ["run"], ["move.v.01"], []),
        ("run", "n", 1, "a score", ["run", "tally"], ["score.n.01"], ["earned.run.n.01"]),
        ("run", "v", 3, "flow", ["run"], [], []),
        ("dog", "n", 1, "an animal", ["dog"], ["canine.n.02"], ["puppy.n.01"]),
    ]
    return spark.createDataFrame(rows, SENSES)


def frames(spark):
    rows = [
        (5, "Cutting", "to cut", ["agent"], "prune.v"),
        (3, "Motion", "to move", ["theme", "goal"], "run away.v"),
        (9, "Animals", "beasts", [], "dog.n"),
    ]
    return spark.createDataFrame(rows, FRAMES)


def tags(spark):
    return spark.createDataFrame([("run", "VBD"), ("the", "DT"), ("dog", "NN")], "word string, tag string")


def test_most_frequent_tag_and_tie(spark):
    rows = [("a", "NN")] * 2 + [("a", "VB")] + [("b", "VB"), ("b", "NN")]
    got = most_frequent_tag(spark.createDataFrame(rows, "word string, tag string")).collect()
    assert {r["word"]: r["tag"] for r in got} == {"a": "NN", "b": "NN"}


def test_first_sense_by_part_of_speech_and_any(spark):
    got = {(r["word"], r["pos"]): r["sense"] for r in first_senses(senses(spark)).collect()}
    assert got["run", "v"]["definition"] == "move fast"
    assert got["run", "*"]["definition"] == "a score"
    assert got["run", "*"]["hyponyms"] == ["earned"]
    assert got["dog", "n"]["hypernyms"] == ["canine"]


def test_frame_match_equals_searching_each_name(spark):
    random.seed(7)
    names = ["".join(random.choices("abc", k=random.randint(1, 7))) + ".v" for _ in range(60)]
    names += ["give up.v", "été.n", "a_bcd.v"]
    rows = [(i, f"f{i}", "d", [], n) for i, n in enumerate(names)]
    words = {"".join(random.choices("abc", k=random.randint(3, 5))) for _ in range(200)} | {
        "give",
        "été",
        "bcd",
        "zzz",
    }
    keys = {r["word"]: r["frame_rank"] for r in frame_keys(spark.createDataFrame(rows, FRAMES)).collect()}
    for word in words:
        matching = [i for i, name in enumerate(names) if word in name]
        assert keys.get(word) == (min(matching) if matching else None), word


def test_exact_frame_match(spark):
    keys = {r["word"]: r["frame_rank"] for r in frame_keys(frames(spark), exact=True).collect()}
    assert keys == {"prune": 5, "run away": 3, "dog": 9}


def test_first_frame_fields(spark):
    got = {r["word"]: r["frame"]["frame_name"] for r in first_frames(frames(spark)).collect()}
    assert got["run"] == "Motion" and got["dog"] == "Animals"


def analyses(spark, texts):
    rows = [(i, t, "positive") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, tweet string, label string")
    found = semantics.analyze_texts(
        df, tags(spark), senses(spark), frames(spark), ["id"], carry=["label"]
    )
    return {r["id"]: r for r in found.collect()}


def test_analysis_takes_parts_by_the_bytes_of_text(spark, monkeypatch):
    rows = [(i, "The dog Run, run dog!", "positive") for i in range(50)]
    df = spark.createDataFrame(rows, "id long, tweet string, label string")

    def found():
        return semantics.analyze_texts(df, tags(spark), senses(spark), frames(spark), ["id"], carry=["label"])

    whole = sorted(map(repr, found().collect()))
    monkeypatch.setattr(semantics, "PART_BYTES", 50)
    parts = found()
    assert parts.rdd.getNumPartitions() == 21  # 50 texts of 21 bytes
    assert sorted(map(repr, parts.collect())) == whole


@pytest.mark.parametrize("limit", [None, "-1"])
def test_analysis_of_a_text(spark, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        if limit:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got = analyses(spark, ["The dog Run, run dog!", None, "", "42 zz"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(got) == [0, 2, 3]
    row = got[0]
    assert row["tokens"] == ["The", "dog", "Run", ",", "run", "dog", "!"]
    assert [tuple(p) for p in row["pos_tags"]] == [
        ("The", "DT"),
        ("dog", "NN"),
        ("Run", "VBD"),
        (",", "NN"),
        ("run", "VBD"),
        ("dog", "NN"),
        ("!", "NN"),
    ]
    # Keyed by surface form, in order of first appearance.
    assert list(row["wordnet_analysis"]) == ["dog", "Run", "run"]
    assert row["wordnet_analysis"]["Run"]["definition"] == "move fast"
    assert row["framenet_analysis"]["dog"]["frame_name"] == "Animals"
    assert row["framenet_analysis"]["run"]["frame_elements"] == ["theme", "goal"]
    assert row["label"] == "positive"
    assert got[2]["tokens"] == [] and got[2]["pos_tags"] == []
    assert got[2]["wordnet_analysis"] in ({}, None)
    assert got[3]["wordnet_analysis"] == {} and got[3]["framenet_analysis"] == {}


def brute_summary(texts, frame_of):
    """Counts in first-seen order per polarity, then a stable sort."""
    tables = {"positive": {}, "negative": {}}
    for text, label in texts:
        table = tables["positive" if label == "positive" else "negative"]
        for word in dict.fromkeys(text.split()):
            name = frame_of.get(word.lower())
            if name:
                table[name] = table.get(name, 0) + 1
    return [
        (name, count, polarity)
        for polarity in ("positive", "negative")
        for name, count in sorted(tables[polarity].items(), key=lambda x: x[1], reverse=True)[:5]
    ]


@pytest.mark.parametrize("limit", [None, 0])
def test_summary_equals_brute_force(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(joins, "broadcast_limit", lambda _: limit)
    random.seed(11)
    words = [f"word{c}" for c in "abcdefghij"]
    rows = [(i, f"Frame{i % 8}", "d", [], f"{w}.v") for i, w in enumerate(words)]
    frame_of = {w: f"Frame{i % 8}" for i, w in enumerate(words)}
    texts = [
        (
            " ".join(random.choice(words + ["Worda", "none"]) for _ in range(random.randint(0, 6))),
            random.choice(["positive", "neutral", "negative", "Positive"]),
        )
        for _ in range(60)
    ]
    df = spark.createDataFrame(
        [(i, t, s) for i, (t, s) in enumerate(texts)], "id long, tweet string, label string"
    )
    # Only whole names match: no word is part of another.
    found = semantics.text_frames(
        df.repartition(3), spark.createDataFrame(rows, FRAMES), "id", "tweet", "label"
    )
    got = semantics.frame_summary(found, "id").drop("rank").collect()
    assert [tuple(r) for r in got] == brute_summary(texts, frame_of)


def test_unknown_words_are_nouns(spark):
    df = spark.createDataFrame([(1, "Blorp run")], "id long, tweet string")
    tokens = semantics.word_tokens(df, ["id"], "tweet")
    got = semantics.tag_tokens(tokens, tags(spark), ["id"]).orderBy(F.col("position")).collect()
    assert [(r["word"], r["tag"]) for r in got] == [("Blorp", "NN"), ("run", "VBD")]


def test_adjective_satellites_are_adjectives(spark):
    senses = spark.createDataFrame(
        [("swift", "s", 1, "quick", ["swift"], ["up.a.01"], ["down.a.01"])],
        "lemma string, pos string, rank int, definition string, synonyms array<string>, hypernyms array<string>, hyponyms array<string>",
    )
    from textpulse.operators.lexicon import first_senses

    assert {r["pos"] for r in first_senses(senses).collect()} == {"a", "*"}
