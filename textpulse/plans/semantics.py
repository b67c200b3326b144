"""Text analysis against word-sense and frame lexicons, and the frame summary."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpulse.functions import contraction_tokens, is_lexical_word, surface_tokens
from textpulse.operators.joins import lookup_join
from textpulse.operators.lexicon import first_frames, word_table
from textpulse.schemas import DEFAULT_TAG, SUMMARY_COLUMNS

TOP_FRAMES = 5
PLACES = 2**31

#: Bytes of text whose tokens a task groups with their entries.
PART_BYTES = 1 << 20


def word_tokens(texts: DataFrame, key: Sequence[str], text: str, contractions: bool = False) -> DataFrame:
    """(key, position, word): one row per token, whole texts, case kept.

    ``contractions`` splits ``don't`` into ``do`` and ``n't`` and keeps ellipses whole.
    """
    tokens = contraction_tokens(F.col(text)) if contractions else surface_tokens(F.col(text))
    return texts.select(*key, F.posexplode(tokens).alias("position", "word"))


def tag_tokens(tokens: DataFrame, tags: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add the tag of every token from a (word, tag) table; unknown words are nouns."""
    keyed = tokens.withColumn("_w", F.lower("word"))
    found = lookup_join(
        keyed,
        tags.select(F.col("word").alias("_w"), "tag"),
        on=["_w"],
        spread_by=[*key, "position"],
    )
    tag = F.coalesce("tag", F.lit(DEFAULT_TAG))
    return found.withColumn("tag", tag).select(*tokens.columns, "tag")


def analyze_texts(
    texts: DataFrame,
    tags: DataFrame,
    senses: DataFrame,
    frames: DataFrame,
    key: Sequence[str],
    text: str = "tweet",
    carry: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """One row per text: tokens, tags, and word -> sense and word -> frame maps.

    Texts without content to analyse are left out; the ``carry`` columns (a label, for
    one) pass through.

    The texts are partitioned by key first, so only raw text crosses the network (for
    the tokens, and again for the row itself): tokens, lookups, both groupings and the
    join back to the text all stay within that partitioning. A text's own tokens are
    the largest group. Every token takes its entries along, many times its own length, so a
    partition holds ``PART_BYTES`` of text, whatever the input: more would spill.
    """
    key = list(key)
    spread = texts.filter(F.col(text).isNotNull()).select(*key, text, *carry)
    spread = spread.repartition(_parts(spread, text), *[F.col(c) for c in key])
    table = word_table(tags, senses, frames, exact).withColumnRenamed("word", "_w")
    tokens = word_tokens(spread, key, text).withColumn("_w", F.lower("word"))
    found = lookup_join(tokens, table, on=["_w"], spread_by=[*key, "position"])

    tag = F.coalesce("tag", F.lit(DEFAULT_TAG))
    lexical = is_lexical_word(F.col("word"))
    # A word seen again keeps its first place and takes its last entry.
    sense = F.max(F.when(lexical & F.col("sense").isNotNull(), F.struct("position", "sense")))
    frame = F.max(F.when(lexical & F.col("frame").isNotNull(), F.struct("position", "frame")))
    tagged_at = F.collect_list(F.struct("position", F.col("word").alias("w"), tag.alias("t")))
    per_word = found.groupBy(*key, "word").agg(
        F.min("position").alias("first_position"),
        tagged_at.alias("tagged"),
        sense.alias("last_sense"),
        frame.alias("last_frame"),
    )
    per_text = per_word.groupBy(*key).agg(
        F.sort_array(F.flatten(F.collect_list("tagged"))).alias("tagged"),
        _ordered_entries("last_sense", "sense").alias("senses"),
        _ordered_entries("last_frame", "frame").alias("frames"),
    )
    pair = lambda t: F.struct(t["w"].alias("word"), t["t"].alias("tag"))
    result = spread.join(per_text, key, "left")
    return result.select(
        *key,
        F.col(text).alias("original_tweet"),
        surface_tokens(F.col(text)).alias("tokens"),
        F.coalesce(F.transform("tagged", pair), F.array()).alias("pos_tags"),
        _to_map("senses").alias("wordnet_analysis"),
        _to_map("frames").alias("framenet_analysis"),
        *carry,
    )


def _parts(texts: DataFrame, text: str) -> int:
    """Partitions of ``PART_BYTES`` of text, but one for each task slot at least."""
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(texts.sparkSession.sparkContext.defaultParallelism, ceil(size / PART_BYTES))


def _ordered_entries(column: str, field: str):
    """(first position, word, entry) of the words that have an entry, in text order."""
    entry = F.struct(
        F.col("first_position").alias("at"),
        F.col("word").alias("word"),
        F.col(column)[field].alias("entry"),
    )
    return F.sort_array(F.collect_list(F.when(F.col(column).isNotNull(), entry)))


def _to_map(column: str):
    pairs = F.transform(column, lambda e: F.struct(e["word"], e["entry"]))
    return F.map_from_entries(pairs)


def text_frames(
    texts: DataFrame,
    frames: DataFrame,
    key: str,
    text: str,
    label: str,
    exact: bool = False,
) -> DataFrame:
    """(label, key, place, frame_name): each distinct surface word that has a frame.

    The key is an integer that also orders the texts.
    Repeats inside a text are removed in the row itself, in first-seen order, so no
    shuffle is needed for them and a hot word counts at most once per text.
    """
    index = first_frames(frames, exact, fields=["frame_name"]).select(
        F.col("word").alias("_w"), F.col("frame.frame_name").alias("frame_name")
    )
    lexical = F.filter(F.array_distinct(surface_tokens(F.col(text))), is_lexical_word)
    words = texts.select(
        F.col(label).alias("label"), key, F.posexplode(lexical).alias("place", "word")
    ).withColumn("_w", F.lower("word"))
    found = lookup_join(words, index, on=["_w"], spread_by=[key, "place"], how="inner")
    return found.select("label", key, "place", "frame_name")


def frame_summary(found: DataFrame, key: str, top: int = TOP_FRAMES) -> DataFrame:
    """The most common frames of positive and of all other texts.

    Only the label ``positive`` counts as positive. Equal counts keep the order in
    which the frames were first met.
    """
    counts = frame_counts(found, key)
    order = Window.partitionBy("polarity").orderBy(F.col("n").desc(), "first_seen")
    ranked = counts.withColumn("rank", F.row_number().over(order))
    ranked = ranked.filter(F.col("rank") <= top)
    rows = ranked.select(
        F.col("frame_name").alias(SUMMARY_COLUMNS[0]),
        F.col("n").alias(SUMMARY_COLUMNS[1]),
        F.col("polarity").alias(SUMMARY_COLUMNS[2]),
        "rank",
    )
    # Positive rows come first, each part in rank order.
    return rows.orderBy(F.col(SUMMARY_COLUMNS[2]).desc(), "rank")


def frame_counts(found: DataFrame, key: str) -> DataFrame:
    """Words per polarity and frame, once per text, and where the frame was first met.

    Text key and place are packed in one number, which keeps this a hash aggregate; a
    struct would make it sort every matched word first.
    """
    polarity = F.when(F.col("label") == "positive", "positive").otherwise("negative")
    seen = F.col(key).cast("decimal(20,0)") * F.lit(PLACES).cast("decimal(11,0)")
    return found.groupBy(polarity.alias("polarity"), "frame_name").agg(
        F.count("*").alias("n"), F.min(seen + F.col("place")).alias("first_seen")
    )
