"""BPE encoding and decoding with a public vocabulary file.

Each word's adjacent pairs sit in a segment tree of their merge ranks. The root is the
lowest rank, leftmost first; a merge changes three leaves, each in logarithmic time, until
the root holds no mergeable pair. A bounded cache keeps the ids of the words met last.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame

from textpulse.llm.common import map_columns

#: Words a Python worker keeps with their ids, in two halves: a full half replaces the other, and a
#: word that is met again moves into the new one.
CACHE_WORDS = 400_000

_NONE = 1 << 62
_LOADED: dict[str, "Encoder"] = {}


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@functools.cache
def newer_letters() -> str:
    """Ranges of letters and numbers that ``regex`` knows and ``unicodedata`` does not yet.

    The public encoder follows the older tables, so such code points are not letters here.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    newer = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    ranges: list[list[int]] = []
    for c in newer:
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


class PairTree:
    """A minimum tree over the ranks of adjacent pairs; equal ranks go to the left.

    A leaf holds rank x width + place, so the least leaf names its place.
    """

    __slots__ = ("width", "nodes")

    def __init__(self, ranks: Sequence[int]):
        width = self.width = 1 << max(0, (len(ranks) - 1).bit_length())
        nodes = self.nodes = [_NONE] * (2 * width)
        for i, r in enumerate(ranks):
            if r != _NONE:
                nodes[width + i] = r * width + i
        for k in range(width - 1, 0, -1):
            left, right = nodes[2 * k], nodes[2 * k + 1]
            nodes[k] = left if left <= right else right

    def put(self, at: int, rank: int) -> None:
        nodes = self.nodes
        k = at + self.width
        value = rank if rank == _NONE else rank * self.width + at
        if nodes[k] == value:
            return
        nodes[k] = value
        while k > 1:
            other = nodes[k ^ 1]
            k >>= 1
            least = value if value <= other else other
            if nodes[k] == least:
                return
            nodes[k] = value = least


class Encoder:
    """Encoder of a vocabulary file (JSON text): NFC, lower case, words, byte letters, merges."""

    def __init__(self, vocabulary: str):
        file = json.loads(vocabulary)
        model = file["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        self.tokens = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + self.suffix] for c in letters]
        self.pairs = {}
        self.merged = []
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs[ids[a] << 32 | ids[b]] = rank
            self.merged.append(ids[a + b])
        split = next(
            p for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        pattern, newer = split["pattern"]["Regex"], newer_letters()
        self.words = regex.compile(pattern)
        self.newer = regex.compile(f"[{newer}]") if newer else None
        #: Bytes below the first byte of the least newer letter: no newer letter begins with one.
        least = newer and newer.encode().decode("unicode_escape")[0]
        self.lower_bytes = bytes(range(least.encode()[0])) if newer else b""
        for kind in (r"\p{L}", r"\p{N}"):
            pattern = pattern.replace(kind, f"[{kind}--[{newer}]]")
        self.older_words = regex.compile(pattern, regex.V1) if newer else self.words
        names = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Ids after all merges, lowest rank first, leftmost among equals."""
        n = len(symbols)
        if n < 2:
            return symbols
        rank, merged = self.pairs.get, self.merged
        tree = PairTree([rank(a << 32 | b, _NONE) for a, b in zip(symbols, symbols[1:])])
        nodes, width, put = tree.nodes, tree.width, tree.put
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (top := nodes[1]) != _NONE:
            r, i = divmod(top, width)
            j = after[i]
            symbol = symbols[i] = merged[r]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                put(j, _NONE)
                put(i, rank(symbol << 32 | symbols[k], _NONE))
            else:
                put(i, _NONE)
                if j < n - 1:
                    put(j, _NONE)
            if (h := before[i]) >= 0:
                put(h, rank(symbols[h] << 32 | symbol, _NONE))
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> bytes:
        """Ids of one word as little-endian unsigned 32-bit integers."""
        if (found := self.older.get(word)) is None:
            data = word.encode()
            symbols = [self.inner[b] for b in data]
            symbols[-1] = self.last[data[-1]]
            found = np.array(self.merge(symbols), "<u4").tobytes()
        if len(word) <= 64:
            if len(self.cache) >= CACHE_WORDS // 2:
                self.older, self.cache = self.cache, {}
            self.cache[word] = found
        return found

    def has_newer(self, low: str) -> bool:
        """Whether a text has letters that the public encoder does not know as such.

        Bytes that only higher code points have are looked for first; most texts have none.
        """
        if self.newer is None or low.isascii() or not low.encode().translate(None, self.lower_bytes):
            return False
        return self.newer.search(low) is not None

    def plain(self, text: str) -> list[bytes]:
        # Letters are lowered one by one: no final form of sigma.
        low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        words = self.older_words if self.has_newer(low) else self.words
        parts = words.findall(low)
        found = list(map(self.cache.get, parts))
        if None in found:
            found = [f or self.word(w) for f, w in zip(found, parts)]
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; no text and an empty text have none."""
        if not text:
            return b""
        if self.specials is None or not self.specials.search(text):
            return b"".join(self.plain(text))
        parts = []
        for k, piece in enumerate(self.specials.split(text)):
            if k % 2:
                parts.append(np.uint32(self.special[piece]).astype("<u4").tobytes())
            else:
                parts.extend(self.plain(piece))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """Tokens with one space between: the file names no decoder of its own."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encoder(vocabulary: str) -> Encoder:
    """One encoder per vocabulary and Python worker."""
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Encoder(vocabulary)
    return _LOADED[key]


def _vocabulary(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids array<int>) of every row; null and empty texts have an empty array.

    The vocabulary file is read by the driver and broadcast: its size does not depend on
    the data. Repeated rows give repeated rows; other columns are not read.
    """
    shared = _vocabulary(docs, path)

    def start():
        coder = encoder(shared.value)

        def step(keys, texts):
            return keys, [np.frombuffer(coder.encode(t), "<u4").astype("i4").tolist() for t in texts]

        return step

    rows = docs.select(key, text)
    return map_columns(rows, f"`{key}` {rows.schema[key].dataType.simpleString()}, ids array<int>", start)


def decode(rows: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, text) of rows with an array of ids; null arrays give a null text."""
    shared = _vocabulary(rows, path)

    def start():
        coder = encoder(shared.value)

        def step(keys, found):
            texts = [None if i is None else coder.decode(np.array(i, "<u4").tobytes()) for i in found]
            return keys, texts

        return step

    rows = rows.select(key, ids)
    return map_columns(rows, f"`{key}` {rows.schema[key].dataType.simpleString()}, text string", start)


def round_trip(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row, in one pass without a shuffle.

    Digests of the ids (little-endian unsigned 32-bit) and of the text decoded from them.
    Null texts count as empty; a null key stays null; repeated rows give repeated rows.
    """
    shared = _vocabulary(docs, path)

    def start():
        coder = encoder(shared.value)

        def step(keys, texts):
            counts, digests, decoded = [], [], []
            for t in texts:
                found = coder.encode(t)
                counts.append(len(found) // 4)
                digests.append(hashlib.sha256(found).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(found).encode()).hexdigest())
            return keys, counts, digests, decoded

        return step

    rows = docs.select(key, text)
    kind = rows.schema[key].dataType.simpleString()
    return map_columns(
        rows, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", start
    )
