"""Spelling variants: words one edit apart, found through a reduced alphabet.

Every letter is hashed to one of a few symbols. Words within one edit have reduced words within one
edit, so each distinct reduced word generates its full one-edit neighbourhood, the neighbours meet
the reduced vocabulary in a join, and the words behind both sides are compared as they are.

A neighbour travels as a 64-bit key, worked out from the key of the reduced word without writing the
neighbour down: long words cost time and memory in proportion to their length. Keys that
collide by chance only add candidates.

Defined results: null texts have no words; a null id counts as the empty string in the deletion
rule; repeated rows count each time; other columns are not read. A word without a near word has
``n_near`` 0, no form, and is its own root. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import append_columns, ready_workers, store

LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A form is this many times as frequent as its variant.
TIMES = 5
#: One run in so many loses a code point (fixed by the contract).
DELETE_ONE_IN = 199
RUN = re.compile("[a-zÀ-ÿ]+")
#: Distinct words a task holds while it counts; beyond, it hands counts on and starts anew.
HELD_WORDS = 200_000
KEYS_IN_BATCH = 1 << 20

_MIX = np.random.default_rng(7).integers(1 << 62, 1 << 63, 256, dtype=np.uint64)  # one value per symbol
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BACK = pow(_BASE, -1, 1 << 64)


# Words and their counts


def thinned(key: str, run: str) -> str:
    """``run`` without one code point if the checksum of ``key:run`` says so."""
    h = zlib.crc32(f"{key}:{run}".encode())
    if h % DELETE_ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n) of the words long and frequent enough, stored.

    A task counts the words of the texts it reads before they are shuffled.
    """
    ready_workers(docs.sparkSession)

    def run(batches):
        counts: Counter[str] = Counter()

        def made():
            words = [w for w in counts if len(w) >= LEAST_LETTERS]
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(words, pa.string()), "n": pa.array([counts[w] for w in words], pa.int64())}
            )

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low = (text or "").encode().lower().decode()  # bytes: A-Z alone
                for word, n in Counter(RUN.findall(low)).items():
                    if len(word) >= LEAST_LETTERS:
                        counts[thinned(key or "", word)] += n
                if len(counts) >= HELD_WORDS:
                    yield made()
                    counts.clear()
        yield made()

    read = docs.select(F.col(id_column).cast("string").alias("key"), F.col(text_column).alias("text"))
    counted = read.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return store(counted.filter(F.col("n") >= LEAST_COUNT), "words")


# The reduced vocabulary and its neighbourhoods


def symbols_for(n_words: int) -> int:
    """Alphabet size: 6 up to a million words, two more for each doubling, 26 at most.

    It decides only how many neighbours and candidates there are, never which words are near.
    """
    doublings = max(0, -(-n_words // (1 << 20)) - 1).bit_length()
    return min(26, 6 + 2 * doublings)


def reduced(word: str, symbols: int) -> bytes:
    points = np.frombuffer(word.encode("utf-32-le"), "<u4")
    return (points % symbols).astype(np.uint8).tobytes()


def _powers(count: int) -> np.ndarray:
    made = np.full(count, _BASE, np.uint64)
    made[:1] = 1
    return np.cumprod(made, dtype=np.uint64)


def key_of(word: bytes) -> int:
    values = _MIX[np.frombuffer(word, np.uint8)]
    with np.errstate(over="ignore"):
        return int((values * _powers(len(word))).sum(dtype=np.uint64).astype(np.int64))


def neighbourhood(word: bytes, symbols: int) -> np.ndarray:
    """Keys of ``word`` and of all words one edit from it, each once."""
    values = _MIX[np.frombuffer(word, np.uint8)]
    size = len(word)
    with np.errstate(over="ignore"):
        powers = _powers(size + 1)
        terms = values * powers[:size]
        before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        whole = before[-1]
        after = whole - before  # terms from each place on
        deleted = before[:-1] + after[1:] * np.uint64(_BACK)
        letters = _MIX[:symbols]
        replaced = whole - terms[:, None] + letters * powers[:size, None]
        inserted = before[:, None] + after[:, None] * np.uint64(_BASE) + letters * powers[:, None]
    return np.unique(np.concatenate([[whole], deleted, replaced.ravel(), inserted.ravel()])).view(np.int64)


def near_reduced(words: DataFrame, symbols: int) -> DataFrame:
    """(a, b): keys of reduced words at most one edit apart, both ways, with themselves too."""
    units = words.select("reduced", "key").distinct()

    def run(batches):
        for batch in batches:
            keys, near, held = [], [], 0
            for word, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = neighbourhood(word, symbols)
                keys.append(np.full(len(found), key, np.int64))
                near.append(found)
                held += len(found)
                if held >= KEYS_IN_BATCH:
                    yield _pairs(keys, near)
                    keys, near, held = [], [], 0
            if held:
                yield _pairs(keys, near)

    probes = units.mapInArrow(run, "a long, b long")
    met = probes.join(units.select(F.col("key").alias("b")).distinct(), "b")
    return met.select("a", "b").distinct()


def _pairs(keys: list[np.ndarray], near: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": np.concatenate(keys), "b": np.concatenate(near)})


def near_words(counts: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words one edit apart, both ways."""
    symbols = symbols_for(counts.count())

    def start():
        def step(words):
            made = [reduced(w, symbols) for w in words]
            return [made, [key_of(r) for r in made]]

        return step

    words = store(append_columns(counts, ["word"], "reduced binary, key long", start), "reduced")
    left = words.select(F.col("key").alias("a"), "word", "n")
    right = words.select(F.col("key").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    candidates = near_reduced(words, symbols).join(left, "a").join(right, "b")
    apart = F.levenshtein("word", "near", 1) == 1
    return candidates.filter(F.col("word") != F.col("near")).filter(apart).select("word", "n", "near", "near_n")


# Forms and roots


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the end of its chain, by doubling steps.

    A form is ``TIMES`` as frequent as its variant, so chains end and the rounds are few.
    """
    steps = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = steps.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        jumped = store(jumped, "roots")
        steps = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            return steps


def group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word."""
    counts = word_counts(docs, id_column, text_column)
    # The greatest count, then the least word: one struct order, merged before the shuffle.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(counts).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    is_form = form_n >= TIMES * F.col("n")
    words = counts.join(near, "word", "left").select(
        "word",
        F.when(is_form, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, form_n).alias("form_n"),
    )
    words = store(words, "forms")
    ends = roots(words.filter(F.col("form").isNotNull()))
    found = words.join(ends, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_sql() -> str:
    """The same rows in DuckDB: edits by deletion at each place instead of reduced words."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    step = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"""
    WITH RECURSIVE runs AS (
      SELECT coalesce(doc_id::VARCHAR, '') AS id,
             unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[a-zÀ-ÿ]+')) AS run
      FROM documents),
    counted AS (SELECT id, run, count(*) AS k FROM runs WHERE length(run) >= {LEAST_LETTERS} GROUP BY ALL),
    bytes AS (
      SELECT run, k, hex(encode(id || ':' || run)) AS h FROM counted),
    sums AS (
      SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT,
          list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT)),
          lambda c, b: {step}), 4294967295) AS crc
      FROM bytes),
    kept AS (
      SELECT CASE WHEN crc % {DELETE_ONE_IN} = 0
             THEN run[1 : crc % length(run)] || run[crc % length(run) + 2 :] ELSE run END AS word, k FROM sums),
    words AS (
      SELECT word, sum(k)::BIGINT AS n FROM kept WHERE length(word) >= {LEAST_LETTERS}
      GROUP BY word HAVING sum(k) >= {LEAST_COUNT}),
    cut AS (
      SELECT word, n, i, word[1 : i] || word[i + 2 :] AS rest
      FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
    near AS (
      SELECT a.word AS word, b.word AS near, b.n AS near_n
      FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
    best AS (
      SELECT word, count(*) AS n_near, max(near_n) AS form_n,
             arg_max(near, (near_n, -ordinal)) AS form
      FROM (SELECT *, row_number() OVER (ORDER BY encode(near)) AS ordinal FROM near) GROUP BY word),
    forms AS (
      SELECT word, n, coalesce(n_near, 0) AS n_near,
             CASE WHEN form_n >= {TIMES} * n THEN form END AS form,
             CASE WHEN form_n >= {TIMES} * n THEN form_n END AS form_n
      FROM words LEFT JOIN best USING (word)),
    chain AS (
      SELECT word, word AS root FROM forms
      UNION ALL
      SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NOT NULL),
    ends AS (SELECT chain.word, root FROM chain JOIN forms ON forms.word = root WHERE forms.form IS NULL)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""
