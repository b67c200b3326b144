"""Quality rules: divergence of a document from language references.

A document's histograms of character classes and of common words are compared with those of
each language of the corpus by Jensen-Shannon distance. It passes when some language is near
in both. Short documents have no stable histogram, so each distance has a minimum length.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpulse.llm.common import map_columns, ready_workers, store

#: What stands between words: exactly what ``bytes.split`` splits on.
GAPS = " \t\n\x0b\x0c\r"
SYMBOLS = re.compile(r"[#*$%&|<>]")
EDGES = ".,;:!?\"'()[]"

#: Character classes: lower vowels, other lower, upper, digits, spaces, line ends, plain
#: punctuation, symbols, other ASCII, letters beyond ASCII, the rest.
CLASSES = 11

COMMON_WORDS = 50
#: Words that a language needs for a stable histogram, whatever the other languages have.
LEAST_WORDS = 1000
MIN_CHARS, MAX_CHAR_DISTANCE = 200, 0.28
MIN_WORDS, MAX_WORD_DISTANCE = 50, 0.47

#: Distinct words that a task counts, or a worker remembers, before it starts anew.
FLUSH_WORDS = 200_000


def _class_table() -> bytes:
    table = bytearray([8] * 128)
    for c in range(128):
        ch = chr(c)
        if ch in "aeiouy":
            table[c] = 0
        elif ch.islower():
            table[c] = 1
        elif ch.isupper():
            table[c] = 2
        elif ch.isdigit():
            table[c] = 3
        elif ch in " \t":
            table[c] = 4
        elif ch in "\n\r":
            table[c] = 5
        elif ch in EDGES + "-":
            table[c] = 6
        elif ch in "#*$%&|<>@^_~=+\\/{}`":
            table[c] = 7
    return bytes(table)


_ASCII = np.frombuffer(_class_table(), np.uint8)


def char_classes(text: str) -> np.ndarray:
    """Counts of the character classes of a text; code points beyond ASCII by being letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    plain = points < 128
    counts = np.bincount(_ASCII[points[plain]], minlength=CLASSES)
    for point, n in zip(*np.unique(points[~plain], return_counts=True)):
        counts[9 if chr(point).isalpha() else 10] += n
    return counts


def words_of(text: str) -> list[bytes]:
    """Runs of anything but space, tab, line feed, vertical tab, form feed and return, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def common_form(word: bytes) -> str:
    return word.decode("utf-8", "replace").lower().strip(EDGES)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Square root of the Jensen-Shannon divergence in bits, along the last axis.

    0 for equal distributions, 1 for disjoint ones; rows of ``q`` are compared at once.
    """
    p, q = p / p.sum(-1, keepdims=True), q / q.sum(-1, keepdims=True)
    middle = np.where(p + q > 0, (p + q) / 2, 1.0)
    left = p * np.log2(np.where(p > 0, p / middle, 1.0))
    right = q * np.log2(np.where(q > 0, q / middle, 1.0))
    return np.sqrt(np.maximum(0.0, (left + right).sum(-1) / 2))


def references(docs: DataFrame, lang: str = "lang", text: str = "text") -> dict[str, dict]:
    """Per language: its character-class counts and its commonest words with their shares.

    Counted over all documents of the language; null languages make none. Languages with
    under ``LEAST_WORDS`` words are no reference. The driver gets ``COMMON_WORDS`` words and
    the class counts of each of the others, about 2 KB a language.
    """

    schema = pa.schema([("lang", pa.string()), ("key", pa.string()), ("n", pa.int64())])

    def run(batches):
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def flush():
            counts: Counter = Counter()
            for name, found in words.items():
                for word, n in found.items():
                    counts[name, common_form(word)] += n
            for name, found in classes.items():
                counts.update({(name, f"\x00{kind}"): n for kind, n in enumerate(found.tolist())})
            words.clear()
            classes.clear()
            rows = list(counts.items())
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in rows], "string"), pa.array([k[1] for k, _ in rows], "string"),
                 pa.array([n for _, n in rows], "int64")], schema=schema)

        for batch in batches:
            for row in range(batch.num_rows):
                name, body = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                words.setdefault(name, Counter()).update(words_of(body))
                classes[name] = classes.get(name, 0) + char_classes(body)
                if sum(map(len, words.values())) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    ready_workers(docs.sparkSession)
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    counted = store(
        rows.mapInArrow(run, "lang string, key string, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")),
        "word-counts",
    )
    is_class = F.startswith("key", F.lit("\x00"))
    totals = counted.groupBy("lang").agg(F.sum(F.when(~is_class, F.col("n"))).alias("words"))
    large = {r["lang"]: r["words"] for r in totals.filter(F.col("words") >= LEAST_WORDS).collect()}
    if not large:
        return {}
    # A common word has at least a thousandth of its language's words: under a thousand rows each.
    listed = docs.sparkSession.createDataFrame(list(large.items()), "lang string, words long")
    common = (
        counted.filter(~is_class & (F.col("key") != ""))
        .join(F.broadcast(listed), "lang")
        .filter(F.col("n") * 1000 >= F.col("words"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "key"))
    made: dict[str, dict] = {name: {"classes": [0] * CLASSES, "words": {}} for name in large}
    for r in common.withColumn("rank", rank).filter(F.col("rank") <= COMMON_WORDS).collect():
        made[r["lang"]]["words"][r["key"]] = r["n"] / r["words"]
    for r in counted.filter(is_class).join(F.broadcast(listed), "lang").collect():
        made[r["lang"]]["classes"][int(r["key"][1:])] = r["n"]
    return made


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, past = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + 3 - max(at, past)
            past = at + 3
    return covered


def duplicate_lines(text: str) -> int:
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line.strip(GAPS):
            again += line in seen
            seen.add(line)
    return again


class Nearest:
    """The nearest of the references: all are compared at once."""

    def __init__(self, refs: dict[str, dict]):
        self.names = sorted(refs)
        self.places = {w: i for i, w in enumerate(sorted({w for r in refs.values() for w in r["words"]}))}
        self.classes = np.array([refs[n]["classes"] for n in self.names], float).reshape(-1, CLASSES)
        # Each reference has its own words only; a place beyond all words fills short rows.
        width = max((len(r["words"]) for r in refs.values()), default=0)
        self.own = np.full((len(self.names), width), len(self.places))
        self.shares = np.zeros((len(self.names), width + 1))
        for row, name in enumerate(self.names):
            for at, (word, share) in enumerate(sorted(refs[name]["words"].items())):
                self.own[row, at] = self.places[word]
                self.shares[row, at] = share
        # A reference's last place is all other words, those common in other languages included.
        self.shares[:, -1] = 1 - self.shares[:, :-1].sum(1)
        self.known: dict[bytes, int] = {}
        # A longer word, up to four marks at its edges included, is none of the common ones.
        self.longest = max((len(w.encode()) for w in self.places), default=0) + 4

    def place(self, word: bytes) -> int:
        if len(self.known) > FLUSH_WORDS:
            self.known.clear()
        found = self.known[word] = self.places.get(common_form(word), -1)
        return found

    def distances(self, text: str, words: list[bytes]) -> tuple[str | None, float, float]:
        """(language, class distance, word distance) of the least sum; ties by name."""
        if not self.names or not words:
            return None, 1.0, 1.0
        counts = np.zeros(len(self.places) + 1)
        known = self.known.get
        longest = self.longest
        for word, n in Counter([w for w in words if len(w) <= longest]).items():
            at = known(word)
            if at is None:
                at = self.place(word)
            if at >= 0:
                counts[at] += n
        own = counts[self.own]
        own = np.hstack([own, len(words) - own.sum(1, keepdims=True)])
        by_class = js_distance(char_classes(text).astype(float), self.classes)
        by_word = js_distance(own, self.shares)
        best = int(np.argmin(by_class + by_word))
        return self.names[best], float(by_class[best]), float(by_word[best])


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, nearest, class_distance, word_distance.

    ``kept`` is false if the base rules fail (under 50 words, or more than half of the words
    in repeated windows), and else true unless the nearest reference is too far: in classes
    for texts of ``MIN_CHARS`` or more, in words for ``MIN_WORDS`` or more. Null texts count
    as no words. A document whose language is null or has no reference is judged by the base
    rules alone; the nearest of the others is told all the same.
    Repeated rows and null keys give rows of their own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(references(docs, lang, text))

    def start():
        nearest = Nearest(shared.value)
        known = set(nearest.names)

        def step(keys, texts, langs):
            out = [[] for _ in range(11)]
            for k, body, own in zip(keys, texts, langs):
                body = body or ""
                words = words_of(body)
                n, again = len(words), repeated_words(words)
                failed = n < 50 or 100 * again > 50 * n
                name, by_class, by_word = nearest.distances(body, words)
                far = own in known and (
                    (len(body) >= MIN_CHARS and by_class > MAX_CHAR_DISTANCE)
                    or (n >= MIN_WORDS and by_word > MAX_WORD_DISTANCE)
                )
                row = (k, n, len(body) - sum(map(body.count, GAPS)), len(SYMBOLS.findall(body)), duplicate_lines(body), again,
                       failed, not failed and not far, name, by_class, by_word)
                for column, value in zip(out, row):
                    column.append(value)
            return out

        return step

    rows = docs.select(key, text, lang)
    kind = rows.schema[key].dataType.simpleString()
    return map_columns(
        rows,
        f"`{key}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, nearest string, class_distance double, word_distance double",
        start,
    )
