"""Training, tuning and scoring queries over whole texts, with language as the class.

Naive Bayes has a closed form, so its SQL recomputes the model from counts and must
predict the same class for every row. A fitted regression has to meet its rows per class;
a forest has to beat the commonest class.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from textpulse.operators.clean import drop_incomplete, stable_split
from textpulse.operators.metrics import classification_report
from textpulse.operators.partitions import spread_rows
from textpulse.plans import models, scoring, tuning
from textpulse.plans.certificate import certificate
from textpulse.plans.runs import transform
from textpulse.plans.training import bounded_share, fit_classifier
from textpulse.schemas import SCORED_COLUMNS
from textpulse.session import new_folder, stored
from textpulse.sources.readers import read_table
from textpulse.sources.writers import load_model, save_model
from textpulse.suite.inputs import CLEAN_SQL, WORDS_SQL, bucket_sql, tweets
from textpulse.suite.registry import query
from textpulse.suite.tables import report_sql, rounded_report
from textpulse.suite.text import TRAINING_SQL, training_rows

#: Labelled rows the forest is fitted on: 262144 bins of 4 bytes each make 1 MB a row.
FOREST_ROWS = 400


def naive_bayes_sql(text: str = "lower(text)", source: str | None = None, smoothing: str = "1.0") -> str:
    """CTEs up to ``scored(id, game, tweet, lang, is_train, label, prediction, name)``.

    ``source`` selects other rows than all texts: (id, game, lang, text, c, is_train);
    ``smoothing`` is an expression. With none, a class without one of a text's words is ruled out.
    """
    source = source or f"""SELECT doc_id AS id, source AS game, lang, text, {text} AS c,
                   {bucket_sql("doc_id::VARCHAR", 10)} < 8 AS is_train
            FROM documents WHERE text IS NOT NULL"""
    return f"""
    src AS ({source}),
    pairs AS (
      SELECT id, lang, is_train, word, count(*) AS tf
      FROM (SELECT id, lang, is_train, unnest({WORDS_SQL}) AS word FROM src) GROUP BY ALL),
    m AS (SELECT count(*)::DOUBLE AS m FROM src WHERE is_train),
    vocab AS (
      SELECT word, ln((any_value(m) + 1) / (count(*) + 1)) AS idf
      FROM pairs, m WHERE is_train GROUP BY word ORDER BY sum(tf) DESC, word LIMIT {models.VOCABULARY_NB}),
    classes AS (
      SELECT lang AS name, count(*)::DOUBLE AS n,
             (row_number() OVER (ORDER BY count(*) DESC, lang) - 1)::DOUBLE AS idx
      FROM src WHERE is_train GROUP BY lang),
    sums AS (
      SELECT lang AS name, word, sum(tf * idf) AS s
      FROM pairs JOIN vocab USING (word) WHERE is_train GROUP BY ALL),
    smooth AS (SELECT l, CASE WHEN l > 0 THEN ln(greatest(l, 1e-9)) ELSE 0 END AS log_l
               FROM (SELECT ({smoothing})::DOUBLE AS l)),
    params AS (
      SELECT name, idx, ln(n + l) - ln(m + l * (SELECT count(*) FROM classes)) AS prior,
             ln((SELECT sum(s) FROM sums x WHERE x.name = c.name) + l * (SELECT count(*) FROM vocab)) AS denom
      FROM classes c, m, smooth),
    weights AS (SELECT id, word, tf * idf AS x FROM pairs JOIN vocab USING (word)),
    totals AS (SELECT id, sum(x) AS t, count(*) AS k FROM weights GROUP BY id),
    hits AS (SELECT id, name, count(*) AS k, sum(x * (ln(s + l) - log_l)) AS h
             FROM weights JOIN sums USING (word) CROSS JOIN smooth GROUP BY ALL),
    best AS (
      SELECT id, name, idx FROM (
        SELECT src.id, p.name, p.idx,
          row_number() OVER (PARTITION BY src.id
            ORDER BY CASE WHEN l = 0 AND coalesce(hits.k, 0) < coalesce(totals.k, 0) THEN '-infinity'::DOUBLE
              ELSE prior - denom * coalesce(t, 0) + coalesce(h, 0) + log_l * coalesce(t, 0) END DESC, p.idx) AS rn
        FROM src CROSS JOIN params p CROSS JOIN smooth LEFT JOIN totals USING (id)
          LEFT JOIN hits ON hits.id = src.id AND hits.name = p.name)
      WHERE rn = 1),
    scored AS (
      SELECT src.id, game, src.text AS tweet, c AS cleaned, lang, is_train, k.idx AS label,
             b.idx AS prediction, b.name AS name
      FROM src JOIN best b USING (id) LEFT JOIN classes k ON k.name = lang)"""


NB_SQL = naive_bayes_sql()


def split_tweets(spark, sf):
    """(train, test) texts, by a bucket of the key."""
    rows = drop_incomplete(tweets(spark, sf).select("id", "sentiment", "tweet"), ["tweet"])
    train, test = stable_split(rows, "id")
    return spread_rows(train, "id", store=True), test


def held_out(spark, sf, pipeline):
    """Fit on the training rows; label, class and name of every test row."""
    train, test = split_tweets(spark, sf)
    scored = scoring.score(fit_classifier(pipeline, train), test, labelled=True)
    return scored.select("id", "label", "prediction", "sentiment_prediction")


MOMENTS_SQL = f"""
    SELECT lang AS label, count(*) AS n_rows, count(*)::DOUBLE AS fitted_rows
    FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL
      AND {bucket_sql("doc_id::VARCHAR", 10)} < 8 GROUP BY lang"""


def fitted_moments(spark, sf, pipeline):
    """Per class: training rows, and the sum of its fitted probability over them.

    A multinomial regression with free intercepts is at its optimum only if the two agree.
    """
    train, _ = split_tweets(spark, sf)
    model = fit_classifier(pipeline, train)
    names = next(s.labels for s in model.stages if hasattr(s, "labels"))
    scored = transform(model, train, ["sentiment", "probability"]).select("sentiment", vector_to_array("probability").alias("p"))
    sums = []
    for k, name in enumerate(names):
        sums.append(F.sum((F.col("sentiment") == name).cast("long")).alias(f"n{k}"))
        sums.append(F.round(F.sum(F.col("p")[k]), 2).alias(f"p{k}"))
    classes = [
        F.struct(F.lit(name).alias("label"), F.col(f"n{k}").alias("n_rows"), F.col(f"p{k}").alias("fitted_rows"))
        for k, name in enumerate(names)
    ]
    return scored.agg(*sums).select(F.inline(F.array(*classes)))


@query("train_lr_vocab", MOMENTS_SQL)
def train_lr_vocab(spark, sf):
    return fitted_moments(spark, sf, models.lr_vocabulary())


#: A fit has settled when its largest gradient is below this share of the one it began with.
SETTLED = 0.01

GRADIENT_SQL = f"""
    WITH src AS (SELECT doc_id AS id, lang, lower(text) AS c FROM documents
                 WHERE text IS NOT NULL AND {bucket_sql("doc_id::VARCHAR", 10)} < 8),
    pairs AS (
      SELECT id, lang, word, count(*) AS tf
      FROM (SELECT id, lang, unnest({WORDS_SQL}) AS word FROM src) GROUP BY ALL),
    total AS (SELECT count(*)::DOUBLE AS n FROM src),
    classes AS (SELECT lang, count(*) AS n_rows FROM src GROUP BY lang),
    vocab AS (
      SELECT word, CASE WHEN count(*) >= {models.MIN_DOC_FREQ} THEN ln((any_value(n) + 1) / (count(*) + 1)) ELSE 0 END AS idf
      FROM pairs, total GROUP BY word ORDER BY sum(tf) DESC, word LIMIT {models.VOCABULARY_LR}),
    whole AS (SELECT word, sum(tf) * any_value(idf) AS s FROM pairs JOIN vocab USING (word) GROUP BY word),
    own AS (SELECT word, lang, sum(tf) * any_value(idf) AS s FROM pairs JOIN vocab USING (word) GROUP BY word, lang)
    SELECT c.lang AS label, n_rows, round(max(abs(n_rows / n * whole.s - coalesce(own.s, 0)) / n), 6) AS start,
           true AS settled
    FROM classes c CROSS JOIN total CROSS JOIN whole LEFT JOIN own ON own.word = whole.word AND own.lang = c.lang
    GROUP BY c.lang, n_rows"""


@query("certify_lr_vocab", GRADIENT_SQL)
def certify_lr_vocab(spark, sf):
    """Per class the largest gradient of intercepts alone, and whether the fit has brought it to nothing."""
    train, _ = split_tweets(spark, sf)
    found = certificate(fit_classifier(models.lr_vocabulary(), train), train)
    return found.select("label", "n_rows", F.round("start", 6).alias("start"), (F.col("fitted") < SETTLED * F.col("start")).alias("settled"))


@query("train_lr_ngrams", MOMENTS_SQL)
def train_lr_ngrams(spark, sf):
    return fitted_moments(spark, sf, models.lr_ngrams())


@query("train_lr_hashed", MOMENTS_SQL)
def train_lr_hashed(spark, sf):
    return fitted_moments(spark, sf, models.lr_hashed())


@query(
    "train_rf",
    f"""SELECT lang AS label, count(*) AS n_rows, true AS beats_majority FROM documents
    WHERE text IS NOT NULL AND {bucket_sql("doc_id::VARCHAR", 10)} >= 8 GROUP BY lang""",
)
def train_rf(spark, sf):
    """Held-out rows per class, and whether the forest names more of them rightly than the
    commonest class would. All buckets; rows bounded by ``FOREST_ROWS``."""
    train, test = split_tweets(spark, sf)
    model = fit_classifier(models.forest_hashed(), bounded_share(train, "id", FOREST_ROWS))
    scored = scoring.score(model, test)
    per_class = scored.groupBy(F.col("sentiment").alias("label")).agg(
        F.count("*").alias("n_rows"),
        F.sum((F.col("sentiment") == F.col("sentiment_prediction")).cast("long")).alias("right"),
    )
    # One row per class.
    right, most = F.sum("right").over(Window.partitionBy()), F.max("n_rows").over(Window.partitionBy())
    return per_class.select("label", "n_rows", (right > most).alias("beats_majority"))


@query(
    "train_nb",
    f"""WITH {NB_SQL} SELECT id, label, prediction, name AS sentiment_prediction
    FROM scored WHERE NOT is_train""",
)
def train_nb(spark, sf):
    return held_out(spark, sf, models.nb_vocabulary())


@query(
    "evaluate_nb",
    report_sql(
        f"WITH {NB_SQL} SELECT label, prediction FROM scored WHERE NOT is_train"
    ),
)
def evaluate_nb(spark, sf):
    """The four metrics of the held-out rows, from one grouped count."""
    return rounded_report(classification_report(train_nb(spark, sf)))


PREPARED_NB_SQL = naive_bayes_sql(
    source=f"""SELECT id, NULL AS game, sentiment AS lang, tweet AS text, tweet AS c, part = 'train' AS is_train
    FROM ({TRAINING_SQL})"""
)


@query(
    "train_nb_prepared",
    f"""WITH {PREPARED_NB_SQL} SELECT id, label, prediction, name AS sentiment_prediction
    FROM scored WHERE NOT is_train""",
)
def train_nb_prepared(spark, sf):
    """The whole flow: clean, drop repeats and short texts, split, fit; then the rows held out.

    No text is on both sides of the split.
    """
    rows = stored(training_rows(spark, sf), "prepared", ["part"])
    model = fit_classifier(models.nb_vocabulary(), rows.filter("part = 'train'").drop("part"))
    scored = scoring.score(model, rows.filter("part = 'test'"), labelled=True)
    return scored.select("id", "label", "prediction", "sentiment_prediction")


@query(
    "evaluate_nb_prepared",
    report_sql(f"WITH {PREPARED_NB_SQL} SELECT label, prediction FROM scored WHERE NOT is_train"),
)
def evaluate_nb_prepared(spark, sf):
    return rounded_report(classification_report(train_nb_prepared(spark, sf)))


CV_SQL = f"""
    WITH src AS (
      SELECT doc_id AS id, lang, lower(text) AS c,
             {bucket_sql("doc_id::VARCHAR || '/fold'", 3)} AS own
      FROM documents
      WHERE text IS NOT NULL AND {bucket_sql("doc_id::VARCHAR", 10)} < 8),
    folds AS (SELECT unnest([0, 1, 2]) AS fold),
    grid AS (SELECT unnest([0.0, 0.5, 1.0])::DOUBLE AS smoothing),
    pairs AS (
      SELECT id, lang, own, word, count(*) AS tf
      FROM (SELECT id, lang, own, unnest({WORDS_SQL}) AS word FROM src) GROUP BY ALL),
    indices AS (
      SELECT lang AS name, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS idx
      FROM src GROUP BY lang),
    m AS (SELECT fold, count(*)::DOUBLE AS m FROM src JOIN folds ON own <> fold GROUP BY fold),
    vocab AS (
      SELECT fold, word, ln((any_value(m) + 1) / (count(*) + 1)) AS idf
      FROM pairs JOIN m ON own <> fold GROUP BY fold, word
      QUALIFY row_number() OVER (PARTITION BY fold ORDER BY sum(tf) DESC, word) <= {models.VOCABULARY_NB}),
    sizes AS (SELECT fold, count(*) AS v FROM vocab GROUP BY fold),
    classes AS (
      SELECT fold, lang AS name, count(*)::DOUBLE AS n
      FROM src JOIN folds ON own <> fold GROUP BY fold, lang),
    sums AS (
      SELECT fold, lang AS name, word, sum(tf * idf) AS s
      FROM pairs JOIN vocab USING (word) WHERE own <> fold GROUP BY ALL),
    class_sums AS (SELECT fold, name, sum(s) AS s FROM sums GROUP BY ALL),
    params AS (
      SELECT fold, name, idx, smoothing,
        ln(n + smoothing) - ln(m + smoothing * (SELECT count(*) FROM indices)) AS prior,
        ln(s + smoothing * v) AS denom
      FROM classes JOIN class_sums USING (fold, name) JOIN m USING (fold)
        JOIN sizes USING (fold) JOIN indices USING (name) CROSS JOIN grid),
    weights AS (
      SELECT fold, id, pairs.word AS word, tf * idf AS x
      FROM pairs JOIN vocab ON own = fold AND pairs.word = vocab.word),
    totals AS (SELECT fold, id, sum(x) AS t, count(*) AS k FROM weights GROUP BY ALL),
    hits AS (
      SELECT fold, id, name, smoothing, count(*) AS k,
        sum(x * (ln(s + smoothing) - CASE WHEN smoothing > 0 THEN ln(greatest(smoothing, 1e-9)) ELSE 0 END)) AS h
      FROM weights JOIN sums USING (fold, word) CROSS JOIN grid GROUP BY ALL),
    raw AS (
      SELECT src.id, src.lang, p.fold, p.name, p.idx, p.smoothing,
        CASE WHEN p.smoothing = 0 AND coalesce(hits.k, 0) < coalesce(totals.k, 0)
             THEN '-infinity'::DOUBLE
             ELSE prior - denom * coalesce(t, 0) + coalesce(h, 0)
               + CASE WHEN p.smoothing > 0 THEN ln(greatest(p.smoothing, 1e-9)) * coalesce(t, 0) ELSE 0 END
        END AS score
      FROM src JOIN params p ON src.own = p.fold
        LEFT JOIN totals ON totals.id = src.id
        LEFT JOIN hits ON hits.id = src.id AND hits.name = p.name AND hits.smoothing = p.smoothing),
    best AS (
      SELECT * FROM raw
      QUALIFY row_number() OVER (PARTITION BY id, smoothing ORDER BY score DESC, idx) = 1),
    fold_accuracy AS (
      SELECT fold, smoothing, avg(CASE WHEN lang = name THEN 1.0 ELSE 0.0 END) AS a
      FROM best GROUP BY ALL),
    mean AS (SELECT smoothing, round(avg(a), 6) AS accuracy FROM fold_accuracy GROUP BY smoothing)
    SELECT smoothing, accuracy,
      row_number() OVER (ORDER BY accuracy DESC, smoothing) = 1 AS chosen FROM mean"""


@query("train_nb_cv", CV_SQL)
def train_nb_cv(spark, sf):
    """Mean held-out accuracy of each smoothing over three folds, and the choice."""
    train, _ = split_tweets(spark, sf)
    tuned = tuning.tune_naive_bayes(train, "id")
    rows = [(s, round(a, 6), s == tuned.smoothing) for s, a in tuned.accuracy.items()]
    return spark.createDataFrame(rows, "smoothing DOUBLE, accuracy DOUBLE, chosen BOOLEAN")


TUNED_SQL = naive_bayes_sql(smoothing=f"SELECT smoothing FROM ({CV_SQL}) WHERE chosen")


@query(
    "evaluate_nb_cv",
    report_sql(f"WITH {TUNED_SQL} SELECT label, prediction FROM scored WHERE NOT is_train"),
)
def evaluate_nb_cv(spark, sf):
    """The four metrics of the tuned model on the rows that neither tuning nor training has seen."""
    train, test = split_tweets(spark, sf)
    model = tuning.tune_naive_bayes(train, "id").model
    return rounded_report(classification_report(scoring.score(model, test, labelled=True)))


def fitted_naive_bayes(spark, sf):
    """Train, save, and load again: what a scoring job starts from."""
    train, _ = split_tweets(spark, sf)
    path = new_folder(spark, "model")
    save_model(fit_classifier(models.nb_vocabulary(), train), path)
    return load_model(path)


@query(
    "score_unlabelled",
    f"""WITH {NB_SQL} SELECT id, game, tweet, name AS sentiment_prediction, prediction
    FROM scored""",
)
def score_unlabelled(spark, sf):
    """Every text scored without its label, named by the fitted label order."""
    rows = drop_incomplete(tweets(spark, sf).drop("sentiment"), ["tweet"])
    rows = spread_rows(rows, "id")
    scored = scoring.score(fitted_naive_bayes(spark, sf), rows)
    return scored.select(*SCORED_COLUMNS)


@query(
    "score_labelled",
    f"""WITH {NB_SQL} SELECT id, game, tweet, label, prediction,
      CASE prediction WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' WHEN 2 THEN 'neutral'
        WHEN 3 THEN 'irrelevant' ELSE 'unknown' END AS sentiment_prediction
    FROM scored WHERE id IN (SELECT doc_id FROM labels)""",
)
def score_labelled(spark, sf):
    """Scoring with the label stage: texts without a rating have a null label and drop."""
    rated = read_table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality")
    known = F.when(F.col("quality").isNotNull(), F.col("sentiment"))
    rows = spread_rows(tweets(spark, sf), "id").join(rated, "id", "left")
    rows = rows.withColumn("sentiment", known)
    scored = scoring.score(
        fitted_naive_bayes(spark, sf),
        drop_incomplete(rows, ["tweet"]),
        labelled=True,
        names=scoring.STREAM,
    )
    return scored.select(*SCORED_COLUMNS, "label")


@query(
    "score_request",
    f"""WITH {NB_SQL} SELECT id, prediction, CASE prediction WHEN 0 THEN 'negative'
      WHEN 1 THEN 'positive' WHEN 2 THEN 'neutral' ELSE 'irrelevant' END AS sentiment
    FROM scored""",
)
def score_request(spark, sf):
    """The on-demand path over many texts: no label stage, three names and a fallback."""
    rows = drop_incomplete(tweets(spark, sf).select("id", "tweet"), ["tweet"])
    rows = spread_rows(rows, "id")
    scored = scoring.score(
        fitted_naive_bayes(spark, sf), rows, names=scoring.REQUEST, output="sentiment"
    )
    return scored.select("id", "prediction", "sentiment")


CLEANED_NB_SQL = naive_bayes_sql(CLEAN_SQL)


@query(
    "score_cleaned",
    f"""WITH {CLEANED_NB_SQL} SELECT id, cleaned AS cleaned_text, prediction, name AS sentiment_prediction
    FROM scored""",
)
def score_cleaned(spark, sf):
    """Raw texts scored by a model that cleans them itself, saved and loaded in between."""
    train, _ = split_tweets(spark, sf)
    path = new_folder(spark, "model")
    save_model(fit_classifier(models.nb_vocabulary(clean=True), train), path)
    rows = drop_incomplete(tweets(spark, sf).select("id", "tweet"), ["tweet"])
    scored = scoring.score(load_model(path), spread_rows(rows, "id"))
    return scored.select("id", models.CLEANED, "prediction", "sentiment_prediction")
