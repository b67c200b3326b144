"""Lexicon tables reduced to one row per lookup key, before any text is touched.

Words, senses and frames are all resolved on the lexicon side. A text word then
needs one equi-join, whatever the rule behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.functions import lexicon_pos, name_heads
from textpulse.functions.text import MIN_LEXICAL_LENGTH
from textpulse.schemas import DEFAULT_TAG

ANY_POS = "*"
ADJECTIVE, SATELLITE = "a", "s"


def most_frequent_tag(tagged: DataFrame, word: str = "word", tag: str = "tag") -> DataFrame:
    """(word, tag): the tag a word has most often, ties in tag order."""
    counts = tagged.groupBy(word, tag).agg(F.count("*").alias("_n"))
    ranked = counts.select(
        F.col(word).alias("word"), F.struct((-F.col("_n")).alias("n"), F.col(tag).alias("tag")).alias("_t")
    )
    best = ranked.groupBy("word").agg(F.min("_t").alias("_t"))
    return best.select("word", F.col("_t.tag").alias("tag"))


def first_senses(senses: DataFrame) -> DataFrame:
    """(word, pos, sense): the best-ranked sense per lemma and part of speech.

    Each sense is also listed under the wildcard ``*``, which is what a word whose
    tag maps to no part of speech looks up. So "any part of speech" is an equality
    too, not an extra join condition. Adjective satellites, part of speech ``s``, are
    adjectives: they are filed under ``a``.
    """
    entries = senses.withColumns(
        {
            "hypernyms": name_heads(F.col("hypernyms")),
            "hyponyms": name_heads(F.col("hyponyms")),
        }
    ).select(
        F.col("lemma").alias("word"),
        "pos",
        "rank",
        F.struct("definition", "synonyms", "hypernyms", "hyponyms").alias("sense"),
    )
    best = F.min(F.struct("rank", "own_pos", "sense")).alias("best")
    return (
        entries.withColumn("own_pos", F.when(F.col("pos") == SATELLITE, ADJECTIVE).otherwise(F.col("pos")))
        .withColumn("pos", F.explode(F.array("own_pos", F.lit(ANY_POS))))
        .groupBy("word", "pos")
        .agg(best)
        .select("word", "pos", F.col("best.sense").alias("sense"))
    )


def frame_keys(frames: DataFrame, exact: bool = False) -> DataFrame:
    """(word, frame_rank): the first frame for every word that can match.

    A word matches a frame when it occurs anywhere inside one of its lexical-unit
    names. Rather than test every word against every name, list the substrings of
    each name once: the match becomes an equality, and the list grows with the
    lexicon alone. Looked-up words are alphanumeric, so only the alphanumeric runs of
    a name matter. ``exact=True`` matches the name before its dot only.
    """
    if exact:
        keys = F.array(F.substring_index("lu_name", ".", 1))
    else:
        runs = F.regexp_extract_all("lu_name", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
        keys = F.array_distinct(F.flatten(F.transform(runs, _substrings)))
    return (
        frames.select(F.explode(keys).alias("word"), "frame_rank")
        .groupBy("word")
        .agg(F.min("frame_rank").alias("frame_rank"))
    )


def _substrings(run):
    """Every substring long enough to be a looked-up word."""
    starts = F.sequence(F.lit(1), F.length(run) - (MIN_LEXICAL_LENGTH - 1))

    def from_start(start):
        lengths = F.sequence(F.lit(MIN_LEXICAL_LENGTH), F.length(run) - start + 1)
        return F.transform(lengths, lambda size: F.substr(run, start, size))

    return F.when(
        F.length(run) >= MIN_LEXICAL_LENGTH, F.flatten(F.transform(starts, from_start))
    ).otherwise(F.array().cast("array<string>"))


def first_frames(
    frames: DataFrame,
    exact: bool = False,
    fields: Sequence[str] = ("frame_name", "frame_definition", "frame_elements"),
) -> DataFrame:
    """(word, frame): the first frame per word, as a struct of ``fields``."""
    entries = frames.groupBy("frame_rank").agg(
        F.min(F.struct(*[F.col(f) for f in fields])).alias("frame")
    )
    return frame_keys(frames, exact).join(entries, "frame_rank").select("word", "frame")


def word_table(
    tags: DataFrame, senses: DataFrame, frames: DataFrame, exact: bool = False
) -> DataFrame:
    """(word, tag, sense, frame) for every word that any lexicon knows.

    A word without a tag is tagged as a common noun. The lexicons are stacked and
    grouped by word, one shuffle in all; a word has at most one tag, one frame and one
    sense per part of speech.
    """
    stacked = (
        tags.select("word", "tag")
        .unionByName(
            first_senses(senses).select("word", F.struct("pos", "sense").alias("of_pos")),
            allowMissingColumns=True,
        )
        .unionByName(first_frames(frames, exact), allowMissingColumns=True)
    )
    per_word = stacked.groupBy("word").agg(
        F.coalesce(F.max("tag"), F.lit(DEFAULT_TAG)).alias("tag"),
        F.collect_list("of_pos").alias("senses"),
        F.max("frame").alias("frame"),
    )
    with_pos = per_word.withColumn("pos", F.coalesce(lexicon_pos(F.col("tag")), F.lit(ANY_POS)))
    fitting = F.filter("senses", lambda s: s["pos"] == F.col("pos"))
    return with_pos.select("word", "tag", F.get(fitting, F.lit(0))["sense"].alias("sense"), "frame")
