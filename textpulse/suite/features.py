"""Term tables: label order, vocabulary, idf, chi-square, hashed counts."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from textpulse.functions import lower_words
from textpulse.operators import terms
from textpulse.plans.models import (
    HASH_BUCKETS,
    MIN_DOC_FREQ,
    SELECTED_FEATURES,
    VOCABULARY_LR,
    label_stage,
    vocabulary_stages,
    words_stage,
)
from textpulse.plans.selection import PresenceSelector
from textpulse.plans.training import fit_stages
from textpulse.session import new_folder
from textpulse.sources.readers import read_table
from textpulse.sources.writers import load_model, save_model
from textpulse.suite.inputs import WORDS_SQL, documents
from textpulse.suite.registry import query

DOC_WORDS_SQL = f"""
doc_words AS (
  SELECT doc_id, lang, {WORDS_SQL} AS w FROM (SELECT doc_id, lang, lower(text) AS c FROM documents)),
pairs AS (
  SELECT doc_id, lang, word, count(*) AS tf
  FROM (SELECT doc_id, lang, unnest(w) AS word FROM doc_words) GROUP BY ALL)"""


def words():
    return lower_words(F.col("text"))


@query(
    "label_index",
    """SELECT lang AS label, count(*) AS n,
      (row_number() OVER (ORDER BY count(*) DESC, lang) - 1)::DOUBLE AS index
    FROM documents GROUP BY lang""",
)
def label_index(spark, sf):
    return terms.label_index(read_table(spark, sf, "documents"), "lang")


@query(
    "vocabulary",
    f"""WITH {DOC_WORDS_SQL}
    SELECT word AS term, sum(tf)::BIGINT AS n,
      row_number() OVER (ORDER BY sum(tf) DESC, word) - 1 AS index
    FROM pairs GROUP BY word ORDER BY n DESC, term LIMIT {VOCABULARY_LR}""",
)
def vocabulary(spark, sf):
    return terms.vocabulary(documents(spark, sf, "text"), words(), VOCABULARY_LR)


@query(
    "idf_weights",
    f"""WITH {DOC_WORDS_SQL}, n AS (SELECT count(*) AS m FROM documents)
    SELECT word AS term, count(*) AS df,
      round(CASE WHEN count(*) >= 5 THEN ln((any_value(m) + 1.0::DOUBLE) / (count(*) + 1)) ELSE 0 END, 6) AS idf
    FROM pairs, n GROUP BY word""",
)
def idf_weights(spark, sf):
    weights = terms.idf_weights(documents(spark, sf, "text"), words(), min_doc_freq=5)
    return weights.withColumn("idf", F.round("idf", 6))


CHI_SQL = f"""WITH {DOC_WORDS_SQL},
    total AS (SELECT count(*)::DOUBLE AS n FROM documents),
    label_rows AS (SELECT lang, count(*)::DOUBLE AS nl FROM documents GROUP BY lang),
    word_rows AS (SELECT word, count(*)::DOUBLE AS nw FROM pairs GROUP BY word),
    both_rows AS (SELECT word, lang, count(*)::DOUBLE AS nwl FROM pairs GROUP BY word, lang),
    cells AS (
      SELECT w.word, w.nw, n, coalesce(nwl, 0) AS o1, nl - coalesce(nwl, 0) AS o0,
             nw * nl / n AS e1, (n - nw) * nl / n AS e0
      FROM word_rows w CROSS JOIN label_rows l CROSS JOIN total
        LEFT JOIN both_rows b ON b.word = w.word AND b.lang = l.lang)
    SELECT word AS term, any_value(nw)::BIGINT AS df,
      round(CASE WHEN any_value(nw) = any_value(n) THEN 0
        ELSE sum((o1 - e1) ^ 2 / e1 + (o0 - e0) ^ 2 / e0) END, 6) AS chi_square
    FROM cells GROUP BY word"""


@query("chi_square", CHI_SQL)
def chi_square(spark, sf):
    """The statistic of every term, from presence in the text against its language."""
    scores = terms.chi_square_terms(documents(spark, sf, "text", "lang"), words(), "lang")
    return scores.withColumn("chi_square", F.round("chi_square", 6))


@query(
    "chi_square_top",
    f"SELECT * FROM ({CHI_SQL}) ORDER BY chi_square DESC, term LIMIT {SELECTED_FEATURES}",
)
def chi_square_top(spark, sf):
    return terms.top_terms(chi_square(spark, sf), "chi_square", SELECTED_FEATURES)


SELECTED_SQL = f"""WITH {DOC_WORDS_SQL},
    chi AS ({CHI_SQL}),
    ranked AS (
      SELECT word AS term, row_number() OVER (ORDER BY sum(tf) DESC, word) AS index
      FROM pairs GROUP BY word ORDER BY index LIMIT {VOCABULARY_LR}),
    chosen AS (
      SELECT term, ln((n + 1.0::DOUBLE) / (df + 1)) AS idf
      FROM chi JOIN ranked USING (term) CROSS JOIN (SELECT count(*) AS n FROM documents)
      WHERE df >= {MIN_DOC_FREQ} AND df < n ORDER BY chi_square DESC, index LIMIT {SELECTED_FEATURES})
    SELECT doc_id, count(term) AS n_selected, round(coalesce(sum(tf * idf), 0), 4) AS weight
    FROM documents LEFT JOIN pairs USING (doc_id) LEFT JOIN chosen ON term = word GROUP BY doc_id"""


@query("select_features", SELECTED_SQL)
def select_features(spark, sf):
    """Selected words of every document and their weight, by a pipeline saved and loaded again."""
    rows = documents(spark, sf, "text", "lang")
    stages = [
        words_stage("text"),
        *vocabulary_stages(VOCABULARY_LR, MIN_DOC_FREQ),
        label_stage("lang", "keep"),
        PresenceSelector(numTopFeatures=SELECTED_FEATURES),
    ]
    path = new_folder(spark, "selector")
    save_model(PipelineModel(fit_stages(stages, rows)[0]), path)
    made = load_model(path).transform(rows).select("doc_id", F.unwrap_udt("selected")["values"].alias("w"))
    kept = F.filter("w", lambda v: v != 0)
    total = F.aggregate(kept, F.lit(0.0), lambda a, v: a + v)
    return made.select("doc_id", F.size(kept).cast("long").alias("n_selected"), F.round(total, 4).alias("weight"))


# 32-bit murmur3 with seed 42 over the UTF-8 bytes of each distinct word.
MURMUR_SQL = """
spelled AS (
  SELECT word, hex(encode(word)) AS h, strlen(word) AS len FROM (SELECT DISTINCT word FROM pairs)),
chunked AS (
  SELECT word, len, list_transform(range(0, len // 4), lambda i:
      ('0x' || h[8*i + 7:8*i + 8] || h[8*i + 5:8*i + 6] || h[8*i + 3:8*i + 4] || h[8*i + 1:8*i + 2])::UBIGINT)
      AS blocks,
    coalesce(list_sum(list_transform(range(0, len % 4), lambda i:
      ('0x' || h[8*(len // 4) + 2*i + 1:8*(len // 4) + 2*i + 2])::UBIGINT * (256 ** i)::UBIGINT)), 0)::UBIGINT AS tail
  FROM spelled),
scrambled AS (
  SELECT word, len, list_transform(list_append(blocks, tail), lambda k: scramble(k)) AS ks FROM chunked),
mixed AS (
  SELECT word, xor(xor(
    list_reduce(ks[1:len // 4], lambda h, k: (rotate(xor(h, k), 13) * 5 + 3864292196) % 4294967296, 42::UBIGINT),
    ks[len // 4 + 1]), len::UBIGINT) AS h
  FROM scrambled),
step1 AS (SELECT word, (xor(h, h // 65536) * 2246822507) % 4294967296 AS h FROM mixed),
step2 AS (SELECT word, (xor(h, h // 8192) * 3266489909) % 4294967296 AS h FROM step1),
buckets AS (SELECT word, xor(h, h // 65536) % {buckets} AS bucket FROM step2)"""
ROTATE_SQL = "(({x} * {left}) % 4294967296 + {x} // {right})"


def murmur_sql(buckets: int) -> str:
    """The CTEs above with their two helper expressions written out."""
    product = "((k * 3432918353) % 4294967296)"
    scrambled = ROTATE_SQL.format(x=product, left=2**15, right=2**17)
    mixed = ROTATE_SQL.format(x="xor(h, k)", left=2**13, right=2**19)
    text = MURMUR_SQL.format(buckets=buckets)
    text = text.replace("scramble(k)", f"({scrambled} * 461845907) % 4294967296")
    return text.replace("rotate(xor(h, k), 13)", mixed)


@query(
    "hashed_tf",
    f"""WITH {DOC_WORDS_SQL}, {murmur_sql(HASH_BUCKETS)},
    filled AS (SELECT doc_id, bucket, sum(tf)::BIGINT AS n
               FROM pairs JOIN buckets USING (word) GROUP BY ALL)
    SELECT d.doc_id, coalesce(string_agg(bucket::VARCHAR, ',' ORDER BY bucket), '') AS buckets,
      coalesce(string_agg(n || '.0', ',' ORDER BY bucket), '') AS counts
    FROM documents d LEFT JOIN filled USING (doc_id) GROUP BY d.doc_id""",
)
def hashed_tf(spark, sf):
    """Hash-bucket counts per document: the two lists of each sparse vector."""
    rows = documents(spark, sf, "text").select("doc_id", words().alias("words"))
    hashing = HashingTF(inputCol="words", outputCol="TF", numFeatures=HASH_BUCKETS)
    vector = hashing.transform(rows).select("doc_id", F.unwrap_udt("TF").alias("tf"))
    return vector.select(
        "doc_id",
        F.array_join("tf.indices", ",").alias("buckets"),
        F.array_join("tf.values", ",").alias("counts"),
    )
