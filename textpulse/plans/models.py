"""The five text classifiers as unfitted Spark ML pipelines.

Every keyword default is the setting the flows are known by; pass others to change
them. ``clean=True`` makes cleaning a part of the model. Input columns are parameters, output columns follow Spark's names.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    IDF,
    ChiSqSelector,
    CountVectorizer,
    HashingTF,
    NGram,
    SQLTransformer,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
)

from textpulse.functions.text import PUNCTUATION
from textpulse.plans.selection import PresenceSelector

# Model settings.
VOCABULARY_LR = 2**16
VOCABULARY_PER_NGRAM = 2**14
VOCABULARY_NB = 2**18
HASH_BUCKETS = 2**18
SELECTED_FEATURES = 2**14
MIN_DOC_FREQ = 5
MAX_NGRAM = 3
FOREST_TREES = 100
FOREST_DEPTH = 15
NB_SMOOTHING = (0.0, 0.5, 1.0)
FOLDS = 3
SEED = 42


#: Column that a cleaning model adds: the text as its words are taken from.
CLEANED = "cleaned_text"


def words_stage(text: str) -> Tokenizer:
    return Tokenizer(inputCol=text, outputCol="words")


def clean_stage(text: str) -> SQLTransformer:
    """``functions.clean_text`` as a stage, saved and loaded with the model it belongs to."""
    cleaned = f"lower(regexp_replace(`{text}`, r'{PUNCTUATION}', ''))"
    return SQLTransformer(statement=f"SELECT *, {cleaned} AS {CLEANED} FROM __THIS__")


def text_stages(text: str, clean: bool) -> list:
    """Words of the text, or of the cleaned text: then scoring cleans as training did."""
    return [clean_stage(text), words_stage(CLEANED)] if clean else [words_stage(text)]


def cleans(model: PipelineModel) -> bool:
    """Whether a fitted pipeline cleans its texts itself."""
    return any(isinstance(s, SQLTransformer) and f" AS {CLEANED} " in s.getStatement() for s in model.stages)


def vocabulary_stages(size: int, min_doc_freq: int = 0, words: str = "words") -> list:
    """Counts over a learned vocabulary, weighted by idf, in ``features``."""
    return [
        CountVectorizer(inputCol=words, outputCol="TF", vocabSize=size),
        IDF(inputCol="TF", outputCol="features", minDocFreq=min_doc_freq),
    ]


def hashed_stages(buckets: int, words: str = "words") -> list:
    """Counts over hash buckets, weighted by idf, in ``features``: no vocabulary pass."""
    return [
        HashingTF(inputCol=words, outputCol="TF", numFeatures=buckets),
        IDF(inputCol="TF", outputCol="features"),
    ]


def ngram_stages(
    max_n: int, size: int, min_doc_freq: int, words: str = "words", binary: bool = False
) -> list:
    """Vocabulary counts and idf for each run length, side by side in ``rawFeatures``."""
    stages, weighted = [], []
    for n in range(1, max_n + 1):
        grams, counts, weights = f"{n}_grams", f"{n}_tf", f"{n}_tfidf"
        stages.append(NGram(n=n, inputCol=words, outputCol=grams))
        stages.append(
            CountVectorizer(inputCol=grams, outputCol=counts, vocabSize=size, binary=binary)
        )
        stages.append(IDF(inputCol=counts, outputCol=weights, minDocFreq=min_doc_freq))
        weighted.append(weights)
    stages.append(VectorAssembler(inputCols=weighted, outputCol="rawFeatures"))
    return stages


def label_stage(sentiment: str, invalid: str) -> StringIndexer:
    return StringIndexer(inputCol=sentiment, outputCol="label", handleInvalid=invalid)


def lr_vocabulary(
    text: str = "tweet",
    sentiment: str = "sentiment",
    size: int = VOCABULARY_LR,
    min_doc_freq: int = MIN_DOC_FREQ,
    max_iter: int = 100,
    clean: bool = False,
) -> Pipeline:
    """Logistic regression on vocabulary tf-idf."""
    return Pipeline(
        stages=[
            *text_stages(text, clean),
            *vocabulary_stages(size, min_doc_freq),
            label_stage(sentiment, "error"),
            LogisticRegression(family="multinomial", maxIter=max_iter),
        ]
    )


def lr_ngrams(
    text: str = "tweet",
    sentiment: str = "sentiment",
    max_n: int = MAX_NGRAM,
    size: int = VOCABULARY_PER_NGRAM,
    min_doc_freq: int = MIN_DOC_FREQ,
    selected: int = SELECTED_FEATURES,
    binary: bool = False,
    max_iter: int = 100,
    by_weight: bool = False,
    clean: bool = False,
) -> Pipeline:
    """Logistic regression on the word runs whose presence chi-square relates most to the label.

    ``by_weight=True`` takes Spark's selector, for which each distinct weight is a category;
    it refuses terms of more than 10,000 weights.
    """
    selector = ChiSqSelector if by_weight else PresenceSelector
    return Pipeline(
        stages=[
            *text_stages(text, clean),
            *ngram_stages(max_n, size, min_doc_freq, binary=binary),
            label_stage(sentiment, "error"),
            selector(numTopFeatures=selected, featuresCol="rawFeatures", outputCol="features"),
            LogisticRegression(maxIter=max_iter),
        ]
    )


def lr_hashed(
    text: str = "tweet",
    sentiment: str = "sentiment",
    buckets: int = HASH_BUCKETS,
    max_iter: int = 100,
    clean: bool = False,
) -> Pipeline:
    """Logistic regression on hashed tf-idf."""
    return Pipeline(
        stages=[
            *text_stages(text, clean),
            *hashed_stages(buckets),
            label_stage(sentiment, "skip"),
            LogisticRegression(family="multinomial", maxIter=max_iter),
        ]
    )


def nb_vocabulary(
    text: str = "tweet",
    sentiment: str = "sentiment",
    size: int = VOCABULARY_NB,
    smoothing: float = 1.0,
    clean: bool = False,
) -> Pipeline:
    """Naive Bayes on vocabulary tf-idf."""
    return Pipeline(
        stages=[
            *text_stages(text, clean),
            *vocabulary_stages(size),
            label_stage(sentiment, "skip"),
            NaiveBayes(smoothing=smoothing),
        ]
    )


def forest_hashed(
    text: str = "tweet",
    sentiment: str = "sentiment",
    buckets: int = HASH_BUCKETS,
    trees: int = FOREST_TREES,
    depth: int = FOREST_DEPTH,
    seed: int = SEED,
    clean: bool = False,
) -> Pipeline:
    """Random forest on hashed tf-idf.

    The forest stores one bin number per bucket and row, also for absent words, so
    memory grows with rows x buckets: bound the rows (``training.bounded_share``).
    """
    return Pipeline(
        stages=[
            *text_stages(text, clean),
            *hashed_stages(buckets),
            label_stage(sentiment, "skip"),
            RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed),
        ]
    )
