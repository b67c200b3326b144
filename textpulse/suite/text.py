"""Cleaning, filters, duplicates, tokens and word runs over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from textpulse.functions import clean_text, lower_words, ngrams, word_count
from textpulse.operators import clean
from textpulse.operators.partitions import spread_rows
from textpulse.sources.readers import read_table
from textpulse.suite.inputs import (
    CLEAN_SQL,
    RATED_SQL,
    WORDS_SQL,
    bucket_sql,
    documents,
    documents_with_labels,
    rated_tweets,
    tweets,
)
from textpulse.suite.registry import query


@query("clean_text", f"SELECT doc_id, {CLEAN_SQL} AS tweet FROM documents WHERE text IS NOT NULL")
def clean_text_query(spark, sf):
    rows = clean.drop_incomplete(documents(spark, sf, "text"), ["text"])
    return rows.select("doc_id", clean_text(F.col("text")).alias("tweet"))


@query(
    "clean_text_unicode",
    r"""SELECT doc_id, lower(regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g')) AS tweet
    FROM documents WHERE text IS NOT NULL""",
)
def clean_text_unicode(spark, sf):
    rows = clean.drop_incomplete(documents(spark, sf, "text"), ["text"])
    return rows.select("doc_id", clean_text(F.col("text"), unicode=True).alias("tweet"))


@query(
    "preprocess",
    f"""WITH {RATED_SQL}
    SELECT id, game, sentiment, {CLEAN_SQL} AS tweet FROM rated
    WHERE id IS NOT NULL AND game IS NOT NULL AND sentiment IS NOT NULL AND text IS NOT NULL""",
)
def preprocess(spark, sf):
    return clean.clean_tweets(rated_tweets(spark, sf, waves=1))


@query(
    "drop_incomplete",
    """SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE d.doc_id IS NOT NULL AND d.text IS NOT NULL AND d.lang IS NOT NULL AND d.source IS NOT NULL
      AND d.n_chars IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
)
def drop_incomplete(spark, sf):
    return clean.drop_incomplete(documents_with_labels(spark, sf))


@query(
    "word_counts",
    "SELECT doc_id, len(string_split(text, ' ')) AS word_count FROM documents",
)
def word_counts(spark, sf):
    rows = read_table(spark, sf, "documents")
    return rows.select("doc_id", word_count(F.col("text")).alias("word_count"))


@query(
    "min_words",
    "SELECT doc_id, lang, text FROM documents WHERE len(string_split(text, ' ')) >= 2",
)
def min_words(spark, sf):
    rows = read_table(spark, sf, "documents").select("doc_id", "lang", "text")
    return clean.keep_min_words(rows, "text", at_least=2)


@query(
    "count_by_source",
    """SELECT source, count(*) AS n FROM documents
    WHERE len(string_split(text, ' ')) >= 2 GROUP BY source""",
)
def count_by_source(spark, sf):
    long_enough = clean.keep_min_words(read_table(spark, sf, "documents"), "text", at_least=2)
    return long_enough.groupBy("source").agg(F.count("*").alias("n"))


@query(
    "dedup_text",
    """SELECT doc_id, text, lang, source, n_chars FROM (
      SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
    WHERE rn = 1""",
)
def dedup_text(spark, sf):
    return clean.drop_repeated_text(read_table(spark, sf, "documents"), "text", "doc_id")


TRAINING_SQL = f"""WITH kept AS (
      SELECT doc_id, lang, {CLEAN_SQL} AS c,
             row_number() OVER (PARTITION BY {CLEAN_SQL} ORDER BY doc_id) AS rn
      FROM documents WHERE text IS NOT NULL)
    SELECT doc_id AS id, lang AS sentiment, c AS tweet,
           CASE WHEN {bucket_sql("doc_id::VARCHAR", 10)} < 8 THEN 'train' ELSE 'test' END AS part
    FROM kept WHERE rn = 1 AND len(string_split(c, ' ')) >= 2"""


@query("training_rows", TRAINING_SQL)
def training_rows(spark, sf):
    """Clean, drop repeats and short texts, and only then split."""
    rows = spread_rows(tweets(spark, sf).select("id", "sentiment", "tweet"), "id")
    rows = clean.clean_tweets(rows, required=["tweet"])
    rows = clean.drop_repeated_text(rows, "tweet", "id")
    return clean.keep_min_words(rows).withColumn("part", clean.split_part("id"))


@query(
    "hash_split",
    f"""SELECT doc_id, CASE WHEN {bucket_sql("doc_id::VARCHAR", 10)} < 8
      THEN 'train' ELSE 'test' END AS part FROM documents""",
)
def hash_split(spark, sf):
    ids = read_table(spark, sf, "documents").select("doc_id")
    return ids.withColumn("part", clean.split_part("doc_id"))


@query(
    "reject_empty",
    """SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'rejected' ELSE 'accepted' END AS outcome
    FROM conversations WHERE text IS NOT NULL""",
)
def reject_empty(spark, sf):
    """System turns are blanked, as no given text is empty."""
    turns = read_table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "system", "").otherwise(F.col("text")).alias("tweet"),
    )
    accepted, rejected = clean.split_empty(turns)
    return (
        accepted.withColumn("outcome", F.lit("accepted"))
        .unionByName(rejected.withColumn("outcome", F.lit("rejected")))
        .drop("tweet")
    )


@query(
    "tokens",
    f"""SELECT doc_id, len(w) AS n_words, array_to_string(w, '|') AS words
    FROM (SELECT doc_id, {WORDS_SQL} AS w FROM (SELECT doc_id, lower(text) AS c FROM documents))""",
)
def tokens(spark, sf):
    words = lower_words(F.col("text"))
    return (
        documents(spark, sf, "text")
        .select("doc_id", words.alias("w"))
        .select("doc_id", F.size("w").alias("n_words"), F.array_join("w", "|").alias("words"))
    )


@query(
    "ngrams",
    f"""WITH words AS (
      SELECT doc_id, {WORDS_SQL} AS w FROM (SELECT doc_id, lower(text) AS c FROM documents)),
    placed AS (
      SELECT doc_id, i, w1, lead(w1, 1) OVER d AS w2, lead(w1, 2) OVER d AS w3
      FROM (SELECT doc_id, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS i FROM words)
      WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
    runs AS (
      SELECT doc_id, i, 1 AS n, w1 AS run FROM placed
      UNION ALL SELECT doc_id, i, 2, w1 || ' ' || w2 FROM placed WHERE w2 IS NOT NULL
      UNION ALL SELECT doc_id, i, 3, w1 || ' ' || w2 || ' ' || w3 FROM placed WHERE w3 IS NOT NULL),
    joined AS (
      SELECT doc_id, n, count(*) AS n_runs, string_agg(run, '|' ORDER BY i) AS runs
      FROM runs GROUP BY doc_id, n)
    SELECT doc_id, n, coalesce(n_runs, 0) AS n_runs, coalesce(runs, '') AS runs
    FROM (SELECT doc_id, unnest([1, 2, 3]) AS n FROM words) LEFT JOIN joined USING (doc_id, n)""",
)
def ngrams_query(spark, sf):
    words = documents(spark, sf, "text").select("doc_id", lower_words(F.col("text")).alias("w"))
    runs = F.array(
        *[F.struct(F.lit(n).alias("n"), ngrams(F.col("w"), n).alias("g")) for n in (1, 2, 3)]
    )
    return words.select("doc_id", F.inline(runs)).select(
        "doc_id", "n", F.size("g").alias("n_runs"), F.array_join("g", "|").alias("runs")
    )
