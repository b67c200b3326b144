"""Benchmark decontamination: SimHash of item-sized windows.

A window of a document, as long as a benchmark item, is a leak when its weighted 5-word
shingles (weight: occurrences) are ``THRESHOLD`` similar to the item's, by weighted Jaccard.
Such a window shares a shingle with the item, so only windows around shared shingles are
fingerprinted. Fingerprints are cut into blocks: within a radius r over m blocks, one block
is within r div m, so block tables find all items in the radius. Found pairs are verified
exactly.
"""

from __future__ import annotations

import zlib
from bisect import bisect, insort
from collections import Counter
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import append_columns, lower_words

SHINGLE = 5
THRESHOLD = 0.8

#: At similarity 0.8 two fingerprints are 10 bits apart on average; 20 is 3.6 deviations more.
RADIUS = 20
BLOCKS, BLOCK_BITS = 4, 16

#: Bytes of item text that are broadcast at a time; a larger benchmark takes several passes.
ITEM_BYTES = 8 << 20

_BITS = np.arange(64, dtype=np.uint64)
_ONES = np.array([bin(v).count("1") for v in range(1 << BLOCK_BITS)], np.uint8)


def shingle_hashes(words: list[str], width: int) -> np.ndarray:
    """64-bit hashes of the runs of ``width`` words."""
    codes = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    made = np.zeros(len(words) - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            made = made * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + len(made)]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            made = (made ^ (made >> np.uint64(shift))) * np.uint64(factor)
    return made ^ (made >> np.uint64(31))


def fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of ``size`` shingles, by running sums of the bits' signs."""
    signs = ((hashes[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) * 2 - 1
    sums = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(signs, 0, dtype=np.int32)])
    positive = (sums[size:] - sums[:-size]) > 0
    return (positive.astype(np.uint64) << _BITS).sum(1, dtype=np.uint64)


class Items:
    """Benchmark items: shingles for anchors, block tables of fingerprints, exact counts."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids: list[int] = []
        self.shingles: list[Counter] = []
        self.sizes: list[int] = []
        self.vocabulary: dict[str, int] = {}
        prints = []
        anchors: dict[int, dict[tuple, list[int]]] = {}
        for item, text in rows:
            words = lower_words(text)
            if not words:
                continue
            width = min(SHINGLE, len(words))
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            counts = Counter(zip(*(codes[k:] for k in range(width))))
            for shingle in counts:
                anchors.setdefault(width, {}).setdefault(shingle, []).append(len(self.ids))
            self.ids.append(item)
            self.shingles.append(counts)
            self.sizes.append(len(words))
            prints.append(fingerprints(shingle_hashes(words, width), len(words) - width + 1)[0])
        self.prints = np.array(prints, np.uint64)
        # Per width: rolled codes of the shared shingles, sorted, and the items of each.
        self.anchors = {}
        for width, found in anchors.items():
            codes = self.rolled(np.array(list(found), np.int64).reshape(-1, width).T)
            order = np.argsort(codes)
            listed = list(found.items())
            self.anchors[width] = (codes[order], [listed[i] for i in order.tolist()])
        # Per block: the items by block value, and the items near a block value as they are asked for.
        blocks = [(self.prints >> np.uint64(BLOCK_BITS * k)) & np.uint64(0xFFFF) for k in range(BLOCKS)]
        self.tables = [np.unique(b, return_inverse=True) for b in blocks]
        self.near: list[dict[int, frozenset[int]]] = [{} for _ in range(BLOCKS)]
        self.whole = self.prints.tolist()

    @staticmethod
    def rolled(columns) -> np.ndarray:
        made = np.zeros(len(columns[0]), np.uint64)
        with np.errstate(over="ignore"):
            for column in columns:
                made = made * np.uint64(0x9E3779B97F4A7C15) + (column.astype(np.uint64) + np.uint64(1))
        return made

    def block_near(self, k: int, block: int) -> frozenset[int]:
        """Items whose k-th block is within the radius' share of a block value."""
        found = self.near[k].get(block)
        if found is None:
            values, where = self.tables[k]
            close = _ONES[values ^ np.uint64(block)] <= RADIUS // BLOCKS
            found = self.near[k][block] = frozenset(np.flatnonzero(close[where]).tolist())
        return found

    def within(self, print_: int, items: frozenset[int] | None = None) -> list[int]:
        """Items, of the given ones or of all, whose fingerprint is within the radius."""
        found: set[int] = set()
        for k in range(BLOCKS):
            near = self.block_near(k, print_ >> BLOCK_BITS * k & 0xFFFF)
            found |= near if items is None else near & items
        return [i for i in sorted(found) if (self.whole[i] ^ print_).bit_count() <= RADIUS]

    def starts(self, codes: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Per item: ranges [first, last] of windows that hold a shared shingle."""
        ranges: dict[int, list[tuple[int, int]]] = {}
        n = len(codes)
        for width, (sought, listed) in self.anchors.items():
            if n < width:
                continue
            known = codes >= 0
            full = np.flatnonzero(np.logical_and.reduce([known[k : n - width + 1 + k] for k in range(width)]))
            if not len(full):
                continue
            rolled = self.rolled([codes[full + k] for k in range(width)])
            at = np.minimum(np.searchsorted(sought, rolled), len(sought) - 1)
            for hit in np.flatnonzero(sought[at] == rolled).tolist():
                place = int(full[hit])
                for item in listed[at[hit]][1]:
                    last = max(0, n - self.sizes[item])
                    first = min(last, max(0, place + width - self.sizes[item]))
                    mine = ranges.setdefault(item, [])
                    if mine and first <= mine[-1][1] + 1:
                        mine[-1] = (mine[-1][0], max(mine[-1][1], min(last, place)))
                    else:
                        mine.append((first, max(first, min(last, place))))
        return ranges

    def similarity(self, window: Counter, item: int) -> float:
        """Weighted Jaccard of shingle counts."""
        theirs = self.shingles[item]
        shared = sum(min(n, window[s]) for s, n in theirs.items() if s in window)
        return shared / (sum(window.values()) + sum(theirs.values()) - shared)

    def leaks(self, text: str | None) -> list[dict]:
        """The leaking windows, by place and item: of those of an item that overlap in a stretch,
        the best, then the best of those that are clear of it, and so on; ties by place."""
        words = lower_words(text)
        get = self.vocabulary.get
        codes = np.array([get(w, -1) for w in words], np.int64)
        found = []
        for item, stretches in self.starts(codes).items():
            size = min(self.sizes[item], len(words))
            width = min(SHINGLE, self.sizes[item])
            for first, last in stretches:
                prints = fingerprints(shingle_hashes(words[first : last + size], width), size - width + 1)
                leaking: list[tuple[float, int, int]] = []
                sought = frozenset((item,))
                for at, print_ in enumerate(prints.tolist(), first):
                    if not self.within(print_, sought):
                        continue
                    window = codes[at : at + size].tolist()
                    alike = self.similarity(Counter(zip(*(window[k:] for k in range(width)))), item)
                    if alike >= THRESHOLD:
                        leaking.append((-alike, at, (self.whole[item] ^ print_).bit_count()))
                kept: list[int] = []
                for alike, at, far in sorted(leaking):
                    k = bisect(kept, at)
                    if any(abs(at - other) < size for other in kept[max(0, k - 1) : k + 1]):
                        continue
                    insort(kept, at)
                    found.append({"item_id": self.ids[item], "start": at, "words": size, "distance": far, "similarity": -alike})
        return sorted(found, key=lambda m: (m["start"], m["item_id"]))


LEAK = "array<struct<item_id:long,start:int,words:int,distance:int,similarity:double>>"


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """All rows and columns, with _leaks: benchmark passages in the text, by place in words.

    The benchmark is the stated query set: it meets all documents in passes of about
    ``ITEM_BYTES`` of items each, without a shuffle of documents. Items of under 5 words are
    one shingle, items without words or id are passed over; null and empty texts have no
    leaks; texts shorter than an item are compared whole. Repeated items are both reported.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_key).cast("long").alias("item"), F.col(item_text).alias("body")).dropna()
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    passes = -(-total // ITEM_BYTES) or 1
    turn = F.pmod(F.xxhash64("item", "body"), F.lit(passes))
    made = docs.withColumn("_leaks", F.array().cast(LEAK))
    for k in range(passes):
        rows = sorted((r["item"], r["body"]) for r in items.filter(turn == k).collect())
        shared = spark.sparkContext.broadcast(rows)
        made = append_columns(made, [text], f"_more {LEAK}", partial(_finder, shared))
        made = made.withColumn("_leaks", F.concat("_leaks", "_more")).drop("_more")
    return made


def _finder(shared):
    items = Items(shared.value)
    return lambda texts: [[items.leaks(t) for t in texts]]
