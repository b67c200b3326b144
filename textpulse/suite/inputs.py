"""How the given tables stand for labelled texts, and the lexicons derived from them.

The same rules are written twice, once per engine: as DataFrames here, as SQL text in
the ``*_SQL`` constants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse.functions import is_lexical_word, md5_bucket, surface_tokens
from textpulse.operators.lexicon import most_frequent_tag
from textpulse.operators.partitions import spread_rows
from textpulse.sources.readers import read_table

TOKEN_SQL = r"regexp_extract_all({0}, '[\p{{L}}\p{{N}}]+|[^\s\p{{L}}\p{{N}}]')"
CLEAN_SQL = r"lower(regexp_replace(text, '[^\w\s]', '', 'g'))"
# ``lower_words`` in SQL, applied to a column called c that is lower case already.
WORDS_SQL = r"""CASE WHEN c = '' THEN ['']
     WHEN regexp_replace(c, '\s+$', '') = '' THEN []::VARCHAR[]
     ELSE string_split_regex(regexp_replace(c, '\s+$', ''), '\s') END"""


def bucket_sql(key: str, buckets: int) -> str:
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT % {buckets})"


def tokens_sql(column: str) -> str:
    return TOKEN_SQL.format(column)


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Columns of ``documents``, over enough partitions for heavy work on the texts."""
    return spread_rows(read_table(spark, sf, "documents").select("doc_id", *columns), "doc_id")


def tweets(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` as labelled texts: whole texts, language as the class."""
    return read_table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("game"),
        F.col("lang").alias("sentiment"),
        F.col("text").alias("tweet"),
    )


def documents_with_labels(spark: SparkSession, sf: str, waves: int = 0) -> DataFrame:
    """Every document, with nulls where it has no label."""
    rows = read_table(spark, sf, "documents")
    if waves:
        rows = spread_rows(rows, "doc_id", waves)
    return rows.join(read_table(spark, sf, "labels"), "doc_id", "left")


def rated_tweets(spark: SparkSession, sf: str, waves: int = 0) -> DataFrame:
    """Labelled texts whose class is the rating as text; null for unrated ones."""
    return documents_with_labels(spark, sf, waves).select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("game"),
        F.col("quality").cast("string").alias("sentiment"),
        F.col("text").alias("tweet"),
    )


RATED_SQL = """
rated AS (
  SELECT d.doc_id AS id, d.source AS game, CAST(l.quality AS VARCHAR) AS sentiment,
         d.text AS text
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def tagged_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Lower-case tokens of the conversations, tagged by the role of their speaker."""
    turns = read_table(spark, sf, "conversations")
    tag = (
        F.when(F.col("role") == "user", "NN")
        .when(F.col("role") == "assistant", "VBD")
        .otherwise("JJ")
    )
    tokens = turns.select(
        F.explode(surface_tokens(F.col("text"))).alias("word"), tag.alias("tag")
    )
    return tokens.withColumn("word", F.lower("word"))


def tag_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return most_frequent_tag(tagged_tokens(spark, sf))


TAGS_SQL = f"""
tagged AS (
  SELECT lower(w) AS word, tag FROM (
    SELECT unnest({tokens_sql('text')}) AS w,
           CASE role WHEN 'user' THEN 'NN' WHEN 'assistant' THEN 'VBD' ELSE 'JJ' END AS tag
    FROM conversations)),
tags AS (
  SELECT word, tag FROM (
    SELECT word, tag, row_number() OVER (PARTITION BY word ORDER BY count(*) DESC, tag) AS rn
    FROM tagged GROUP BY word, tag) WHERE rn = 1)"""


def benchmark_words(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct lower-case words of the benchmark texts, three characters or more."""
    items = read_table(spark, sf, "benchmark")
    words = items.select(F.explode(surface_tokens(F.col("text"))).alias("word"))
    return words.filter(is_lexical_word(F.col("word"))).select(F.lower("word").alias("word")).distinct()


def senses(spark: SparkSession, sf: str) -> DataFrame:
    """A word-sense lexicon made from the benchmark words."""
    words = benchmark_words(spark, sf).withColumnRenamed("word", "lemma")
    lemma = F.col("lemma")
    pos = F.element_at(
        F.array(*[F.lit(p) for p in ("n", "v", "a", "r", "s")]),
        (md5_bucket(lemma, 5) + 1).cast("int"),
    )
    ranks = F.when(md5_bucket(lemma, 3) == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    ranked = words.select(lemma, pos.alias("pos"), F.explode(ranks).alias("rank"))
    return ranked.select(
        "lemma",
        "pos",
        "rank",
        F.concat(F.lit("sense "), F.col("rank").cast("string"), F.lit(" of "), lemma).alias(
            "definition"
        ),
        F.array(lemma, F.concat(lemma, F.lit("_"), F.col("rank").cast("string"))).alias(
            "synonyms"
        ),
        F.array(F.concat(F.lit("up_"), lemma, F.lit(".n.01"))).alias("hypernyms"),
        F.array(
            F.concat(F.lit("down_"), lemma, F.lit(".n.01")),
            F.concat(F.lit("low_"), lemma, F.lit(".n.02")),
        ).alias("hyponyms"),
    )


WORDS_CTE_SQL = f"""
bench AS (
  SELECT DISTINCT lower(w) AS lemma
  FROM (SELECT unnest({tokens_sql('text')}) AS w FROM benchmark)
  WHERE regexp_matches(w, '^[\\p{{L}}\\p{{N}}]+$') AND length(w) > 2)"""

SENSES_SQL = f"""{WORDS_CTE_SQL},
senses AS (
  SELECT lemma, ['n', 'v', 'a', 'r', 'a'][({bucket_sql('lemma', 5)} + 1)::INT] AS pos, rank,
         'sense ' || rank || ' of ' || lemma AS definition,
         [lemma, lemma || '_' || rank] AS synonyms,
         ['up_' || lemma || '.n.01'] AS hypernyms,
         ['down_' || lemma || '.n.01', 'low_' || lemma || '.n.02'] AS hyponyms
  FROM bench JOIN (SELECT unnest([1, 2]) AS rank)
    ON rank = 1 OR {bucket_sql('lemma', 3)} = 0)"""


def frames(spark: SparkSession, sf: str) -> DataFrame:
    """A frame lexicon made from the benchmark words of three to five letters."""
    words = benchmark_words(spark, sf).filter(
        F.col("word").rlike(r"^\p{L}+$") & F.length("word").between(3, 5)
    )
    ranked = words.withColumn("frame_rank", md5_bucket(F.col("word"), 12).cast("int"))
    name = F.concat(F.lit("frame_"), F.col("frame_rank").cast("string"))
    return ranked.select(
        "frame_rank",
        name.alias("frame_name"),
        F.concat(F.lit("about "), name).alias("frame_definition"),
        F.array(F.lit("agent"), F.lit("theme")).alias("frame_elements"),
        F.concat(F.col("word"), F.lit(".v")).alias("lu_name"),
    )


FRAMES_SQL = f"""
frame_words AS (
  SELECT DISTINCT lower(w) AS lu FROM (SELECT unnest({tokens_sql('text')}) AS w FROM benchmark)
  WHERE regexp_matches(w, '^\\p{{L}}+$') AND length(lower(w)) BETWEEN 3 AND 5),
frames AS (
  SELECT {bucket_sql('lu', 12)}::INT AS frame_rank,
         'frame_' || {bucket_sql('lu', 12)} AS frame_name,
         'about frame_' || {bucket_sql('lu', 12)} AS frame_definition,
         ['agent', 'theme'] AS frame_elements, lu || '.v' AS lu_name
  FROM frame_words)"""
