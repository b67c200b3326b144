"""Tokens, tags, senses, frames, whole analyses and the frame summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from textpulse import functions
from textpulse.functions import is_lexical_word, lexicon_pos
from textpulse.functions.tokens import contraction_tokens_sql
from textpulse.operators.joins import lookup_join
from textpulse.operators.lexicon import ANY_POS, first_frames, first_senses
from textpulse.plans import semantics
from textpulse.session import new_folder
from textpulse.sources import writers
from textpulse.sources.readers import read_table
from textpulse.suite import inputs
from textpulse.suite.inputs import FRAMES_SQL, SENSES_SQL, TAGS_SQL, tokens_sql
from textpulse.suite.registry import query

TURN = ["conv_id", "turn"]

TURN_TOKENS_SQL = f"""
toks AS (
  SELECT conv_id, turn, unnest(range(0, len(t))) AS position, unnest(t) AS word
  FROM (SELECT conv_id, turn, {tokens_sql('text')} AS t FROM conversations))"""

LEXICAL_SQL = "regexp_matches(word, '^[\\p{L}\\p{N}]+$') AND length(word) > 2"
POS_SQL = """CASE substr(tag, 1, 2) WHEN 'JJ' THEN 'a' WHEN 'VB' THEN 'v'
  WHEN 'NN' THEN 'n' WHEN 'RB' THEN 'r' END"""


def turn_tokens(spark, sf):
    return semantics.word_tokens(read_table(spark, sf, "conversations"), TURN, "text")


@query(
    "word_tokens",
    f"""WITH {TURN_TOKENS_SQL}
    SELECT conv_id, turn, position, word, {LEXICAL_SQL} AS lexical FROM toks""",
)
def word_tokens(spark, sf):
    return turn_tokens(spark, sf).withColumn("lexical", is_lexical_word(F.col("word")))


@query(
    "contraction_tokens",
    f"""WITH toks AS (SELECT doc_id, {contraction_tokens_sql("text")} AS w FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, len(w) AS n_tokens, len(list_filter(w, lambda t: regexp_matches(t, '^[''].'))) AS n_endings,
      md5(array_to_string(w, ' ')) AS tokens_md5 FROM toks""",
)
def contraction_tokens(spark, sf):
    """Tokens of every document, contractions split: their number, those after an apostrophe, a digest."""
    rows = inputs.documents(spark, sf, "text").filter("text IS NOT NULL")
    made = rows.select("doc_id", functions.contraction_tokens(F.col("text")).alias("w"))
    return made.select(
        "doc_id",
        F.size("w").cast("long").alias("n_tokens"),
        F.size(F.filter("w", lambda t: t.rlike("^[']."))).cast("long").alias("n_endings"),
        F.md5(F.array_join("w", " ")).alias("tokens_md5"),
    )


@query("tag_lexicon", f"WITH {TAGS_SQL} SELECT word, tag FROM tags")
def tag_lexicon(spark, sf):
    return inputs.tag_lexicon(spark, sf)


@query(
    "tag_tokens",
    f"""WITH {TAGS_SQL}, bench_tokens AS (
      SELECT item_id, unnest(range(0, len(t))) AS position, unnest(t) AS word
      FROM (SELECT item_id, {tokens_sql('text')} AS t FROM benchmark))
    SELECT item_id, position, b.word AS word, coalesce(t.tag, 'NN') AS tag,
      {POS_SQL.replace('substr(tag', "substr(coalesce(t.tag, 'NN')")} AS pos
    FROM bench_tokens b LEFT JOIN tags t ON lower(b.word) = t.word""",
)
def tag_tokens(spark, sf):
    """Benchmark tokens, some of which the conversation tags do not know."""
    tokens = semantics.word_tokens(read_table(spark, sf, "benchmark"), ["item_id"], "text")
    tagged = semantics.tag_tokens(tokens, inputs.tag_lexicon(spark, sf), ["item_id"])
    return tagged.withColumn("pos", lexicon_pos(F.col("tag")))


@query(
    "sense_lookup",
    f"""WITH {TURN_TOKENS_SQL}, {TAGS_SQL}, {SENSES_SQL},
    tagged_turns AS (
      SELECT k.*, coalesce(t.tag, 'NN') AS tag FROM toks k LEFT JOIN tags t ON lower(k.word) = t.word
      WHERE regexp_matches(k.word, '^[\\p{{L}}\\p{{N}}]+$') AND length(k.word) > 2),
    matched AS (
      SELECT k.*, s.definition, s.synonyms, s.hypernyms, s.hyponyms,
        row_number() OVER (PARTITION BY conv_id, turn, position ORDER BY s.rank) AS rn
      FROM tagged_turns k JOIN senses s ON lower(k.word) = s.lemma
        AND ({POS_SQL} IS NULL OR {POS_SQL} = s.pos))
    SELECT conv_id, turn, position, word, definition, array_to_string(synonyms, '|') AS synonyms,
      array_to_string(list_transform(hypernyms, lambda x: split_part(x, '.', 1)), '|') AS hypernyms,
      array_to_string(list_transform(hyponyms, lambda x: split_part(x, '.', 1)), '|') AS hyponyms
    FROM matched WHERE rn = 1""",
)
def sense_lookup(spark, sf):
    """The first sense of every conversation word that has one."""
    lexical = turn_tokens(spark, sf).filter(is_lexical_word(F.col("word")))
    tagged = semantics.tag_tokens(lexical, inputs.tag_lexicon(spark, sf), TURN)
    keyed = tagged.select(
        *TURN,
        "position",
        "word",
        F.lower("word").alias("_w"),
        F.coalesce(lexicon_pos(F.col("tag")), F.lit(ANY_POS)).alias("pos"),
    )
    index = first_senses(inputs.senses(spark, sf)).withColumnRenamed("word", "_w")
    found = lookup_join(keyed, index, on=["_w", "pos"], spread_by=[*TURN, "position"], how="inner")
    return found.select(
        *TURN,
        "position",
        "word",
        "sense.definition",
        F.array_join("sense.synonyms", "|").alias("synonyms"),
        F.array_join("sense.hypernyms", "|").alias("hypernyms"),
        F.array_join("sense.hyponyms", "|").alias("hyponyms"),
    )


FRAME_MATCH_SQL = """
lex_words AS (SELECT DISTINCT lower(word) AS w FROM toks WHERE {lexical}),
first_frame AS (
  SELECT w, arg_min(frame_name, frame_rank) AS frame_name,
         arg_min(frame_definition, frame_rank) AS frame_definition,
         arg_min(frame_elements, frame_rank) AS frame_elements
  FROM lex_words JOIN frames ON {match} GROUP BY w)"""


def frame_match_sql(match: str) -> str:
    return FRAME_MATCH_SQL.format(lexical=LEXICAL_SQL, match=match)


def _frame_lookup(spark, sf, exact):
    lexical = turn_tokens(spark, sf).filter(is_lexical_word(F.col("word")))
    keyed = lexical.withColumn("_w", F.lower("word"))
    index = first_frames(inputs.frames(spark, sf), exact).withColumnRenamed("word", "_w")
    found = lookup_join(keyed, index, on=["_w"], spread_by=[*TURN, "position"], how="inner")
    return found.select(
        *TURN,
        "position",
        "word",
        "frame.frame_name",
        "frame.frame_definition",
        F.array_join("frame.frame_elements", "|").alias("frame_elements"),
    )


def frame_lookup_sql(match: str) -> str:
    return f"""WITH {TURN_TOKENS_SQL}, {FRAMES_SQL}, {frame_match_sql(match)}
    SELECT conv_id, turn, position, word, frame_name, frame_definition,
      array_to_string(frame_elements, '|') AS frame_elements
    FROM toks JOIN first_frame ON lower(word) = w WHERE {LEXICAL_SQL}"""


@query("frame_lookup", frame_lookup_sql("instr(lu_name, w) > 0"))
def frame_lookup(spark, sf):
    """The first frame with a lexical unit that contains the word."""
    return _frame_lookup(spark, sf, exact=False)


@query("frame_lookup_exact", frame_lookup_sql("split_part(lu_name, '.', 1) = w"))
def frame_lookup_exact(spark, sf):
    """The first frame with a lexical unit named by the word."""
    return _frame_lookup(spark, sf, exact=True)


def analyses(spark, sf):
    turns = read_table(spark, sf, "conversations").select(
        *TURN, F.col("text").alias("tweet"), F.col("role").alias("label")
    )
    return semantics.analyze_texts(
        turns,
        inputs.tag_lexicon(spark, sf),
        inputs.senses(spark, sf),
        inputs.frames(spark, sf),
        key=TURN,
        carry=["label"],
    )


ANALYSIS_SQL = f"""WITH {TURN_TOKENS_SQL}, {TAGS_SQL}, {SENSES_SQL}, {FRAMES_SQL},
    {frame_match_sql("instr(lu_name, w) > 0")},
    tagged_turns AS (
      SELECT k.*, coalesce(t.tag, 'NN') AS tag FROM toks k LEFT JOIN tags t ON lower(k.word) = t.word),
    pos_tags AS (
      SELECT conv_id, turn, string_agg(word || '/' || tag, ' ' ORDER BY position) AS pos_tags
      FROM tagged_turns GROUP BY conv_id, turn),
    lexical AS (
      SELECT *, {POS_SQL} AS pos FROM tagged_turns WHERE {LEXICAL_SQL}),
    places AS (
      SELECT conv_id, turn, word, min(position) AS first_position, max(position) AS last_position
      FROM lexical GROUP BY conv_id, turn, word),
    sensed AS (
      SELECT l.conv_id, l.turn, l.word, l.position, s.definition, s.synonyms, s.hypernyms, s.hyponyms
      FROM lexical l JOIN senses s ON lower(l.word) = s.lemma AND (l.pos IS NULL OR l.pos = s.pos)
      QUALIFY row_number() OVER (PARTITION BY l.conv_id, l.turn, l.word
                                 ORDER BY l.position DESC, s.rank) = 1),
    sense_text AS (
      SELECT p.conv_id, p.turn, string_agg(p.word || '=' || definition || '~' ||
          array_to_string(synonyms, '+') || '~' ||
          array_to_string(list_transform(hypernyms, lambda x: split_part(x, '.', 1)), '+') || '~' ||
          array_to_string(list_transform(hyponyms, lambda x: split_part(x, '.', 1)), '+'),
          '|' ORDER BY first_position) AS senses
      FROM places p JOIN sensed s USING (conv_id, turn, word) GROUP BY p.conv_id, p.turn),
    frame_text AS (
      SELECT conv_id, turn, string_agg(word || '=' || frame_name || '~' || frame_definition || '~' ||
          array_to_string(frame_elements, '+'), '|' ORDER BY first_position) AS frames
      FROM places JOIN first_frame ON lower(word) = w GROUP BY conv_id, turn)
    SELECT c.conv_id, c.turn, c.role AS label, c.text AS original_tweet,
      array_to_string({tokens_sql('c.text')}, ' ') AS tokens,
      coalesce(pos_tags, '') AS pos_tags, coalesce(senses, '') AS senses,
      coalesce(frames, '') AS frames
    FROM conversations c LEFT JOIN pos_tags USING (conv_id, turn)
      LEFT JOIN sense_text USING (conv_id, turn) LEFT JOIN frame_text USING (conv_id, turn)
    WHERE c.text IS NOT NULL"""


def flat_analyses(found):
    """Analyses with their lists and maps as text, in stored order."""
    sense = lambda e: F.concat_ws(
        "~",
        e["definition"],
        F.array_join(e["synonyms"], "+"),
        F.array_join(e["hypernyms"], "+"),
        F.array_join(e["hyponyms"], "+"),
    )
    frame = lambda e: F.concat_ws(
        "~", e["frame_name"], e["frame_definition"], F.array_join(e["frame_elements"], "+")
    )

    def entries(column, render):
        pairs = F.transform(
            F.map_entries(column), lambda p: F.concat(p["key"], F.lit("="), render(p["value"]))
        )
        return F.coalesce(F.array_join(pairs, "|"), F.lit(""))

    tagged = F.transform("pos_tags", lambda p: F.concat(p["word"], F.lit("/"), p["tag"]))
    return found.select(
        *TURN,
        "label",
        "original_tweet",
        F.array_join("tokens", " ").alias("tokens"),
        F.array_join(tagged, " ").alias("pos_tags"),
        entries("wordnet_analysis", sense).alias("senses"),
        entries("framenet_analysis", frame).alias("frames"),
    )


@query("text_analysis", ANALYSIS_SQL)
def text_analysis(spark, sf):
    return flat_analyses(analyses(spark, sf))


@query("analysis_json_round_trip", ANALYSIS_SQL)
def analysis_json_round_trip(spark, sf):
    """The analyses written as JSON lines and read back under their schema.

    Maps come back in file order, which is the order in the text.
    """
    path = new_folder(spark, "analyses")
    found = analyses(spark, sf)
    writers.write_json_lines(found, path)
    return flat_analyses(spark.read.schema(found.schema).json(path))


SUMMARY_SQL = f"""WITH {FRAMES_SQL}, rated AS (
      SELECT d.doc_id, d.text, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
    toks AS (
      SELECT doc_id, quality, unnest(t) AS word, unnest(range(0, len(t))) AS position
      FROM (SELECT doc_id, quality, {tokens_sql('text')} AS t FROM rated)),
    once AS (
      SELECT doc_id, quality, word, min(position) AS position FROM toks
      WHERE {LEXICAL_SQL} GROUP BY doc_id, quality, word),
    {frame_match_sql("instr(lu_name, w) > 0")},
    seen AS (
      SELECT CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS polarity, frame_name,
             count(*) AS n, min((doc_id, position)) AS first_seen
      FROM once JOIN first_frame ON lower(word) = w GROUP BY ALL),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY polarity ORDER BY n DESC, first_seen) AS rank
      FROM seen)"""

SUMMARY_ROWS_SQL = f"""{SUMMARY_SQL}
    SELECT frame_name AS "Frame", n AS "Count", polarity AS "Sentiment", rank
    FROM ranked WHERE rank <= 5 ORDER BY polarity DESC, rank"""


def rated_frames(spark, sf):
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    rated = inputs.documents(spark, sf, "text").join(labels, "doc_id")
    named = rated.withColumn(
        "label", F.when(F.col("quality") == 1, "positive").otherwise("neutral")
    )
    return semantics.text_frames(
        named, inputs.frames(spark, sf), "doc_id", text="text", label="label"
    )


@query("frame_summary", SUMMARY_ROWS_SQL)
def frame_summary(spark, sf):
    return semantics.frame_summary(rated_frames(spark, sf), "doc_id")


@query(
    "frame_counts",
    f"{SUMMARY_SQL} SELECT polarity, frame_name, n, first_seen[1] AS first_doc FROM ranked",
)
def frame_counts(spark, sf):
    counts = semantics.frame_counts(rated_frames(spark, sf), "doc_id")
    first_doc = F.floor(F.col("first_seen") / semantics.PLACES).cast("bigint")
    return counts.select("polarity", "frame_name", "n", first_doc.alias("first_doc"))


@query(
    "summary_csv_round_trip",
    f"""SELECT "Frame", "Count", "Sentiment" FROM ({SUMMARY_ROWS_SQL})""",
)
def summary_csv_round_trip(spark, sf):
    path = new_folder(spark, "summary")
    writers.write_summary(frame_summary(spark, sf).drop("rank"), path)
    schema = "Frame STRING, Count BIGINT, Sentiment STRING"
    return spark.read.schema(schema).option("header", True).csv(path)
