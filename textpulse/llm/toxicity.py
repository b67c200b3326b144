"""Toxicity: nearest labelled examples by exact TF-IDF cosine.

Every labelled example is a vector over all terms of the examples: words, and the starts of
longer words, which stand for their derived forms. A term's idf weighs the more the more its
examples lean to toxic ones. Spark counts the terms and stores the vectors in the shared
folder; workers read them there, and the driver sees counts alone. The index is block-max:
examples of like words stand in blocks, and every term of middling frequency keeps the
largest weight that it has in each block. A text adds up its rare terms by postings and its
commonest ones by a dense matrix; with the block maxima that bounds every example, and only
for examples whose bound reaches the k-th score found so far the middling terms are added.
The longest examples, which most neighbours are among, are dense in the middling terms too.
The best are worked out again in double precision. Votes weighted by cosine, calibrated on the examples themselves with each one left out, give a score and its
evidence.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.llm import common
from textpulse.llm.common import append_columns, lower_words, map_columns, ready_workers, row_key, store
from textpulse.session import new_folder

#: Labelled rows used at most: those with the smallest hashes of their id.
MAX_LABELLED = 16_384

#: A term that only toxic examples hold weighs 1 + LEAN times its idf; its share of toxic
#: examples is steadied by so many more examples at the prior.
LEAN, STEADY = 10.0, 5.0

#: A term that this share of the examples holds is a row of the dense matrix.
COMMON_SHARE = 0.1

#: A term that no more than this share of the examples holds is read by its postings.
RARE_SHARE = 0.04

NEIGHBOURS = 15

#: Examples in a block.
BLOCK = 8

#: This share of the examples, the longest ones, is dense in the middling terms too: most neighbours are among them.
LONG_SHARE = 1 / 16
SMOOTHING = 0.5
BINS = 50
STARTS = (4, 5, 6)

#: Base of the hashes, an odd number of 64 bits.
BASE = 0xD6E8FEB86659FD93

#: Texts whose dense scores are worked out at a time, examples opened at first, and what
#: rounding of single-precision scores and bounds can be at most.
TEXTS, OPENED, SLACK = 256, 64, 1e-4

#: Steps of a packed weight.
FINE = (1 << 16) - 1

#: Commonest terms whose presence orders the examples, which parts languages; examples read at a time.
ORDERING, READ_ROWS = 8, 256


Vector = tuple[np.ndarray, np.ndarray]


def content(text: str | None) -> int:
    """A digest of the words and their order: texts equal in it are equal to the operator."""
    return digest(lower_words(text))


def digest(words: list[str]) -> int:
    return int.from_bytes(hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=8).digest(), signed=True)


class Places:
    """Finds values among others that are in order and spread evenly, such as hashes; like ``searchsorted``."""

    def __init__(self, values: np.ndarray):
        self._values = np.append(values, np.iinfo(np.int64).max)
        self._shift = np.int64(max(0, 63 - len(values).bit_length()))
        self._low = np.int64(np.iinfo(np.int64).min) >> self._shift
        edges = np.arange(self._low, -self._low, dtype=np.int64) << self._shift
        self._begins = np.searchsorted(values, edges).astype(np.int32)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        at = self._begins[(wanted >> self._shift) - self._low]
        left = np.flatnonzero(self._values.take(at) < wanted)
        while len(left):
            at[left] += 1
            left = left[self._values.take(at[left]) < wanted[left]]
        return at


class Hashes:
    """64-bit hashes of the terms of texts, of many texts at a time. Terms of equal hash are one term.

    A run of code points has the hash sum(mixed(c_j) * BASE^j), mixed again; sums that begin with the batch give
    that of every word and start of one. ``most`` code points are worked on at a time, or one longer text.

    With ``terms``, hashes in order, a term goes by its place there, and others by numbers from
    ``len(terms)`` on, made from their hashes.
    """

    def __init__(self, most: int = 1 << 18, terms: np.ndarray | None = None):
        self._most, self._terms = most, terms
        self._up = self._down = np.ones(1, np.uint64)

    def counts(self, text: str | None) -> Vector:
        """Hashes in order, and how often their terms occur."""
        return self.of_words([lower_words(text)])[0]

    def of_words(self, texts: list[list[str]]) -> list[Vector]:
        """``counts`` of texts that are given as their words."""
        made, part, size = [], [], 0
        for words in texts:
            more = sum(map(len, words)) + len(words)
            if part and size + more > self._most:
                made += self._counts(part)
                part, size = [], 0
            part.append(words)
            size += more
        return made + self._counts(part)

    def _counts(self, texts: list[list[str]]) -> list[Vector]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        hashes, word = self._hashes(" ".join([" ".join(words) for words in texts if words]))
        text = np.repeat(np.arange(len(texts)), sizes)[word]
        # Numbers for the hashes, in their order; a term of a text is then one number too.
        order = np.argsort(hashes)
        hashes = hashes[order]
        first = np.ones(len(hashes), bool)
        first[1:] = hashes[1:] != hashes[:-1]
        number = np.cumsum(first) - 1
        places = self._places(hashes[first])
        if self._terms is not None:
            # Known terms come first.
            turn = np.argsort(places >= len(self._terms), kind="stable")
            back = np.empty(len(turn), np.int64)
            back[turn] = np.arange(len(turn))
            number, places = back[number], places[turn]
        pairs = np.sort(text[order] * len(places) + number)
        first = np.ones(len(pairs) + 1, bool)
        first[1:-1] = pairs[1:] != pairs[:-1]
        begins = np.flatnonzero(first)
        text, number = np.divmod(pairs[begins[:-1]], max(1, len(places)))
        edges = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
        places, often = places[number], np.diff(begins).astype(float)
        return [(places[x], often[x]) for x in map(slice, edges[:-1], edges[1:])]

    def _hashes(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all terms of words that a space parts, and the words that they come from."""
        if not joined:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if joined.isascii():
            codes = np.frombuffer(joined.encode("ascii"), np.uint8)
        else:
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.append(np.flatnonzero(codes == 32), len(codes))
        begins = np.append(0, ends[:-1] + 1)
        while len(self._up) <= len(codes):
            for name, base in (("_up", BASE), ("_down", pow(BASE, -1, 1 << 64))):
                powers = np.full(2 * max(len(codes), self._most) + 1, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_mixed(codes) * self._up[: len(codes)], out=sums[1:])
        down, before = self._down[begins], sums[begins]
        hashes, of = [_mixed((sums[ends] - before) * down)], [np.arange(len(begins))]
        for k in STARTS:
            words = np.flatnonzero(ends - begins > k)
            # Another sum than the word's that is spelt like the start.
            hashes.append(_mixed((sums[begins[words] + k] - before[words]) * down[words] + np.uint64(k)))
            of.append(words)
        return np.concatenate(hashes).view(np.int64), np.concatenate(of)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        if self._terms is None:
            return hashes
        places = np.searchsorted(self._terms, hashes)
        other = np.ones(len(hashes), bool)
        if len(self._terms):
            other = self._terms.take(places, mode="clip") != hashes
        return np.where(other, len(self._terms) + (hashes.view(np.uint64) >> np.uint64(2)).astype(np.int64), places)


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix."""
    z = numbers.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _fill(ends: np.ndarray, lists: np.ndarray, target: np.ndarray, values: np.ndarray) -> None:
    """Appends values to lists that lie one after the other; ``ends`` has where each goes on."""
    order = np.argsort(lists, kind="stable")
    found, first, counts = np.unique(lists[order], return_index=True, return_counts=True)
    target[np.repeat(ends[found] - first, counts) + np.arange(len(order))] = values[order]
    ends[found] += counts.astype(ends.dtype)


class Index:
    """Unit vectors of examples: whole, and as postings, block maxima and a dense matrix.

    ``edges`` parts ``places`` (terms, in order) and ``often`` (their weights before ``scale``, the weight
    of a term) into examples. Of equal cosines the one of lower ``ranks`` is nearer.
    """

    def __init__(self, vectors: list[dict[int, float]], labels: list[int], keys: list[int], n_terms: int):
        edges = np.cumsum([0, *map(len, vectors)])
        places = np.array([t for v in vectors for t in sorted(v)], np.int64)
        often = np.array([v[t] for v in vectors for t in sorted(v)], float)
        self._build(edges, places, often, np.ones(n_terms), labels, keys, np.arange(len(keys)))

    @classmethod
    def of_arrays(cls, *parts) -> Index:
        made = cls.__new__(cls)
        made._build(*parts)
        return made

    def _build(self, edges, places, often, scale, labels, keys, ranks) -> None:
        self.edges, self.places, self.often, self.scale = edges, places, often, scale
        self.labels, self.keys, self.ranks = np.array(labels, float), keys, ranks
        self.at = {k: r for r, k in enumerate(keys)}
        self.blocks_met = self.blocks_opened = 0
        n, n_terms = len(keys), len(scale)
        self.n, self.blocks = n, -(-n // BLOCK)
        held = np.bincount(places, minlength=n_terms)
        common = held >= max(1, COMMON_SHARE * n)
        middle = ~common & (held > RARE_SHARE * n)
        rare = ~common & ~middle
        # The rows of common terms, then those of middle ones.
        self.dense_at = np.full(n_terms, -1, np.int32)
        self.n_common = int(common.sum())
        self.dense_at[common] = np.arange(self.n_common)
        self.dense_at[middle] = np.arange(self.n_common, self.n_common + int(middle.sum()))
        self._lay_out(held)
        self.dense = np.zeros((self.n_common, self.blocks * BLOCK), np.float32)
        # Blocks of long examples come first and have no maxima; a column for each of their examples instead.
        self.long = np.zeros((int(middle.sum()), self.n_long * BLOCK), np.float32)
        self.tops = np.zeros((int(middle.sum()), self.blocks - self.n_long), np.float32)
        self.sizes = np.where(rare, held, 0).astype(np.int32)
        self.begins = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)
        self.rare = np.zeros(int(self.sizes.sum()), np.int64 if max(self.blocks * BLOCK, len(self.tops)) >> 15 else np.int32)
        # Middle terms of every spot, one after the other.
        each = np.zeros(self.blocks * BLOCK + 1, np.int64)
        each[self.spots + 1] = np.add.reduceat(np.append(middle[places], False), edges[:-1], dtype=np.int64) * (np.diff(edges) > 0) if n else 0
        self.middle_edges = np.cumsum(each)
        self.middle = np.zeros(int(self.middle_edges[-1]), self.rare.dtype)
        # Filled in from few examples at a time, so that nothing is sorted whole.
        ends, middle_ends = self.begins.copy(), self.middle_edges[:-1].copy()
        for at, spot, value in self._parts():
            here = common[at]
            self.dense[self.dense_at[at[here]], spot[here]] = value[here]
            block = spot % self.blocks
            here = middle[at] & (block < self.n_long)
            column = spot[here] // self.blocks * self.n_long + block[here]
            self.long[self.dense_at[at[here]] - self.n_common, column] = value[here]
            here = middle[at]
            row = self.dense_at[at[here]] - self.n_common
            _fill(middle_ends, spot[here], self.middle, self._packed(row, value[here]))
            other = block[here] >= self.n_long
            np.maximum.at(self.tops, (row[other], block[here][other] - self.n_long), value[here][other])
            here = rare[at]
            _fill(ends, at[here], self.rare, self._packed(spot[here], value[here]))
        # How often an example has each term, while its cosines are worked out; zeros between.
        self._held = np.zeros(n_terms)

    def _packed(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """A place and its weight in 16 bits, rounded up, in one number."""
        return (places.astype(self.rare.dtype) << 16) | np.minimum(np.ceil(weights * FINE), FINE).astype(self.rare.dtype)

    def _parts(self):
        """Terms, spots and unit weights of the vectors, ``READ_ROWS`` examples at a time."""
        for first in range(0, self.n, READ_ROWS):
            edges = self.edges[first : first + READ_ROWS + 1]
            at, sizes = self.places[edges[0] : edges[-1]], np.diff(edges)
            lengths = np.repeat(self.lengths[first : first + READ_ROWS], sizes)
            value = self.often[edges[0] : edges[-1]] * self.scale[at] / lengths
            yield at, np.repeat(self.spots[first : first + READ_ROWS], sizes), value.astype(np.float32)

    def _lay_out(self, held: np.ndarray) -> None:
        """Lengths of the vectors, and a spot for each: those of like words and lengths in one block,
        those of most terms in the first blocks.

        Spot s is in block s % blocks, so that what is known of blocks is added to rows of spots.
        """
        bits = np.full(len(held), -1, np.int8)
        top = np.argsort(-held, kind="stable")[:ORDERING]
        bits[top] = np.arange(len(top))
        self.lengths, signs = np.ones(self.n), np.zeros(self.n, np.int64)
        for r in range(self.n):
            part = slice(self.edges[r], self.edges[r + 1])
            at = self.places[part]
            raw = self.often[part] * self.scale[at]
            self.lengths[r] = math.sqrt(float(raw @ raw)) or 1.0
            has = bits[at]
            signs[r] = sum(1 << (ORDERING - 1 - int(b)) for b in has[has >= 0])
        self.n_long = int(LONG_SHARE * self.n) // BLOCK
        short = np.ones(self.n, bool)
        short[np.lexsort((self.ranks, -np.diff(self.edges)))[: self.n_long * BLOCK]] = False
        order, turn = np.lexsort((self.ranks, self.lengths, signs, short)), np.arange(self.n)
        self.spots = np.empty(self.n, np.int32)
        self.spots[order] = turn % BLOCK * self.blocks + turn // BLOCK
        self.row_at = np.full(self.blocks * BLOCK, -1, np.int32)
        self.row_at[self.spots] = np.arange(self.n)
        self.vacant = np.flatnonzero(self.row_at < 0)

    def nearest(self, vector: dict[int, float], k: int, leave: int | None = None) -> list[tuple[float, int]]:
        """(cosine, row) of the k nearest examples with a cosine above 0, best first; ties by rank.

        ``leave`` is the key of an example that does not count.
        """
        query = np.array(list(vector), np.int64), np.array(list(vector.values()), float)
        return self.nearest_each([query], k, [leave])[0]

    def nearest_each(self, queries: list[Vector], k: int, leaves: list[int | None]) -> list[list[tuple[float, int]]]:
        """``nearest`` of several vectors, as arrays of terms and weights."""
        met = []
        for at in range(0, len(queries), TEXTS):
            part = queries[at : at + TEXTS]
            ours = np.zeros((len(part), self.n_common + len(self.tops)), np.float32)
            for q, (terms_, weights) in enumerate(part):
                where = self.dense_at[terms_]
                ours[q, where[where >= 0]] = weights[where >= 0]
            middle = ours[:, self.n_common :]
            scores = ours[:, : self.n_common] @ self.dense
            scores.reshape(len(part), BLOCK, -1)[:, :, : self.n_long] += (middle @ self.long).reshape(len(part), BLOCK, -1)
            each = zip(scores, middle @ self.tops, middle, part, leaves[at : at + TEXTS])
            met += [self._near(*x, *query, k, self.at.get(leave)) for *x, query, leave in each]
        return self._best(queries, met, k)

    def _near(self, scores: np.ndarray, bounds: np.ndarray, ours: np.ndarray, terms_: np.ndarray, weights: np.ndarray, k: int, leave: int | None):
        """The rows that may be among the k nearest.

        ``scores`` by spot, of common terms, and of middle ones for long examples; ``bounds`` by other blocks, of
        the most that middle terms can add. ``ours`` has the weights of the middle terms.
        """
        if not len(terms_) or not self.n:
            return np.zeros(0, np.int32)
        sizes = self.sizes[terms_]
        rare = np.flatnonzero(sizes)
        # Packed weights are too high by a step at most.
        over = SLACK + float(weights.sum()) / FINE
        if len(rare):
            sizes, begins = sizes[rare], self.begins[terms_[rare]]
            lists = map(slice, begins.tolist(), (begins + sizes).tolist())
            found = np.concatenate([self.rare[x] for x in lists])
            added = (found & FINE).astype(np.float32)
            added *= np.repeat((weights[rare] / FINE).astype(np.float32), sizes)
            np.add.at(scores, found >> 16, added)
        scores[self.vacant] = -np.inf
        if leave is not None:
            scores[self.spots[leave]] = -np.inf
        upper = scores.reshape(BLOCK, -1).copy()
        upper[:, self.n_long :] += bounds
        # The spots of the highest bounds first; then those that the k-th score so far leaves.
        heads, upper = upper.max(0), upper.ravel()
        bar = float(np.partition(heads, -k)[-k]) if len(heads) > k else 0.0
        first = upper >= bar if bar > 0 else upper > 0
        spots = np.flatnonzero(first)
        full = scores[spots] + self._middle(spots, ours)
        least = self._least(full, k) - over
        left = np.flatnonzero((upper >= least) & (upper > 0) & ~first)
        left = left[np.argsort(-upper[left], kind="stable")]
        at, opened = 0, OPENED
        while at < len(left) and upper[left[at]] >= least:
            more = left[at : at + opened]
            spots, full = np.concatenate([spots, more]), np.concatenate([full, scores[more] + self._middle(more, ours)])
            at, opened = at + opened, 2 * opened
            least = self._least(full, k) - over
        self.blocks_met += self.blocks
        self.blocks_opened += len(np.unique(spots % self.blocks))
        return self.row_at[spots[(full >= least) & (full > 0)]]

    def _best(self, queries: list[Vector], met: list[np.ndarray], k: int) -> list[list[tuple[float, int]]]:
        """The best of the rows met, by their cosines in double precision.

        Texts meet the same examples again and again, so an example is opened once for all of them.
        """
        made: list[list[tuple[float, int, int]]] = [[] for _ in queries]
        ours = [weights * self.scale[terms_] for terms_, weights in queries]
        of, rows = np.repeat(np.arange(len(met)), list(map(len, met))), np.concatenate([np.zeros(0, np.int32), *met])
        order = np.argsort(rows, kind="stable")
        last = -1
        for q, r in zip(of[order].tolist(), rows[order].tolist()):
            if r != last:
                self._open(last, False)
                self._open(r, True)
                last, rank, length = r, int(self.ranks[r]), self.lengths[r]
            cosine = round(float((self._held.take(queries[q][0]) * ours[q]).sum() / length), 12)
            if cosine > 0:
                made[q].append((-min(1.0, cosine), rank, r))
        self._open(last, False)
        return [[(-c, r) for c, _, r in sorted(best)[:k]] for best in made]

    def _open(self, row: int, begin: bool) -> None:
        if row >= 0:
            part = slice(self.edges[row], self.edges[row + 1])
            self._held[self.places[part]] = self.often[part] if begin else 0

    @staticmethod
    def _least(scores: np.ndarray, k: int) -> float:
        return float(np.partition(scores, -k)[-k]) if len(scores) >= k else 0.0

    def _middle(self, spots: np.ndarray, ours: np.ndarray) -> np.ndarray:
        """What the middle terms add to the scores of these spots, no less than it is; nothing for long examples."""
        begins, ends = self.middle_edges[spots], self.middle_edges[spots + 1]
        full = np.flatnonzero((ends > begins) & (spots % self.blocks >= self.n_long))
        made = np.zeros(len(spots), np.float32)
        if len(full) and len(ours):
            found = np.concatenate([self.middle[x] for x in map(slice, begins[full].tolist(), ends[full].tolist())])
            added = ours.take(found >> 16)
            added *= found & FINE
            sizes = (ends - begins)[full]
            made[full] = np.add.reduceat(added, np.cumsum(sizes) - sizes) / FINE
        return made


def _read(folder: str, columns: list[str]):
    """Record batches of a stored table, file after file; a few rows at a time."""
    files, path = pafs.FileSystem.from_uri(folder) if ":" in folder else (pafs.LocalFileSystem(), folder)
    found = pads.dataset(path, filesystem=files, format="parquet")
    for part in sorted(found.get_fragments(), key=lambda f: f.path):
        yield from part.to_batches(columns=columns, batch_size=READ_ROWS, use_threads=False, batch_readahead=0, fragment_readahead=0)


class Examples:
    """What a worker holds of a fitted model: the terms' hashes and weights, and the index."""

    def __init__(self, model: Model):
        found = [np.zeros((3, 0), np.int64)]
        found += [np.stack([c.to_numpy() for c in b.columns]) for b in _read(f"{model.folder}/terms", ["term", "toxic", "clean"])]
        term, toxic, clean = np.concatenate(found, axis=1)
        order = np.argsort(term)
        self.terms, held = term[order], (toxic + clean)[order]
        lean = (toxic[order] + STEADY * model.prior) / (held + STEADY) - model.prior
        lean = np.maximum(0.0, lean) / (1 - model.prior) if model.prior < 1 else np.zeros(len(held))
        self.weights = (np.log((model.n + 1) / (held + 1)) + 1) * (1 + LEAN * lean)
        self.new_weight = math.log(model.n + 1) + 1
        del found, term, toxic, clean, order, held, lean
        sizes, places, often, others = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.uint16)], []
        place_of = Places(self.terms).of
        for b in _read(f"{model.folder}/vectors", ["row", "label", "content", "terms", "often"]):
            sizes.append(b.column("terms").value_lengths().to_numpy().astype(np.int64))
            places.append(place_of(b.column("terms").flatten().to_numpy()))
            counts = b.column("often").flatten().to_numpy()
            often.append(counts.astype(np.uint16 if counts.max(initial=0) < 1 << 16 else np.int32))
            others.append(np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("row", "label", "content")]))
        row, label, digest = np.concatenate(others, axis=1) if others else np.zeros((3, 0), np.int64)
        edges = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
        places, often = np.concatenate(places), np.concatenate(often)
        del place_of
        pa.default_memory_pool().release_unused()
        ranks = np.empty(len(row), np.int64)
        ranks[np.lexsort((row, label, digest))] = np.arange(len(row))
        self.index = Index.of_arrays(
            edges, places, often, self.weights, (label > 0).astype(int), row.tolist(), ranks
        )
        self.hashes, self.known = Hashes(terms=self.terms), {}

    def vector(self, text: str | None) -> Vector:
        """Unit TF-IDF vector of the terms that the examples have; other terms add to its length."""
        return self.vectors([lower_words(text)])[0]

    def vectors(self, texts: list[list[str]]) -> list[Vector]:
        """``vector`` of texts that are given as their words."""
        return [self._unit(*counts) for counts in self.hashes.of_words(texts)]

    def _unit(self, found: np.ndarray, often: np.ndarray) -> Vector:
        known = int(np.searchsorted(found, len(self.terms)))
        found, others = found[:known], often[known:] * self.new_weight
        raw = often[:known] * self.weights[found]
        length = math.sqrt(float(raw @ raw) + float(others @ others))
        return found, raw / length if len(raw) else raw


class Model:
    """A folder with the terms and the vectors of the examples, and the calibration of votes.

    Only counts are in the object, so it goes along with tasks.
    """

    def __init__(self, folder: str, n: int, prior: float):
        self.folder, self.n, self.prior = folder, n, prior
        # No neighbour, then the bins of the votes; set by `calibrate`.
        self.no_vote, self.steps = prior, np.linspace(0, 1, BINS + 1)

    def loaded(self) -> Examples:
        """The examples, read once in a process while its tasks use them."""
        return common.HELD.get(self.folder, lambda: Examples(self))

    @property
    def examples(self) -> tuple:
        """Keys and labels of the examples that have a word."""
        index = self.loaded().index
        return index.keys, index.labels

    def votes(self, texts: list[list[str]], leaves: list[int | None]) -> list[tuple[float, list[tuple[float, int]]]]:
        """(vote, neighbours) of each text, given as its words; the vote is -1 without a neighbour."""
        held = self.loaded()
        index = held.index
        made = []
        for near in index.nearest_each(held.vectors(texts), NEIGHBOURS, leaves):
            if not near:
                made.append((-1.0, []))
                continue
            weights = np.array([c for c, _ in near])
            labels = index.labels[[r for _, r in near]]
            vote = float((weights @ labels + SMOOTHING * self.prior) / (weights.sum() + SMOOTHING))
            made.append((min(1.0, vote), near))
        return made

    def calibrate(self, bins: dict[int, tuple[int, int]]) -> None:
        """``bins``: bin (-1: no neighbour) to (examples, toxic ones). Monotone by pooling neighbours."""
        n, y = bins.get(-1, (0, 0))
        self.no_vote = (y + SMOOTHING * self.prior) / (n + SMOOTHING)
        pools: list[list[float]] = []
        for b in range(BINS + 1):
            n, y = bins.get(b, (0, 0))
            # Half an example at the bin's own vote steadies empty bins.
            pools.append([y + 0.5 * b / BINS, n + 0.5, 1])
            while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
                y2, n2, k2 = pools.pop()
                pools[-1] = [pools[-1][0] + y2, pools[-1][1] + n2, pools[-1][2] + k2]
        self.steps = np.concatenate([[y / n] * k for y, n, k in pools])

    def scores(self, texts: list[str | None]) -> list[tuple[float, list[tuple[float, int]]]]:
        """(score, neighbours) of each text; texts of the same words are voted on once."""
        words, known = [lower_words(t) for t in texts], self.loaded().known
        keys = [digest(w) for w in words]
        if len(known) > 10_000:
            known.clear()
        new = {k: w for k, w in zip(keys, words) if k not in known}
        for k, (vote, near) in zip(new, self.votes(list(new.values()), [None] * len(new))):
            known[k] = vote, near[:3]
        made = ((self.no_vote if vote < 0 else float(self.steps[round(vote * BINS)]), near) for vote, near in map(known.get, keys))
        return [(min(1.0, max(0.0, score)), near) for score, near in made]


def held_out(key: str = "doc_id") -> Column:
    """Rows never learnt from: crc32 of the id as text is divisible by 5; null ids are not."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of at most ``MAX_LABELLED`` labelled rows that are not held out.

    Rows of one label that have the same words in the same order are one example, so a group
    of copies has one vote. Null labels and ids without a text are passed over; an id with
    several labels is toxic if one says so. Without toxic examples every score is the prior, 0.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    chosen = (
        labels.select(key, F.col(label).cast("int").alias("_label")).dropna()
        .filter(~held_out(key))
        .groupBy(key)
        .agg(F.max("_label").alias("_label"))
        .orderBy(F.xxhash64(key), key)
        .limit(MAX_LABELLED)
    )
    # At most MAX_LABELLED rows of an id and a label.
    rows = docs.select(key, text, row_key(key, text).alias("_row")).join(F.broadcast(store(chosen, "toxic-labels")), key)

    def contents():
        return lambda keys, labels, texts: (keys, labels, texts, [content(t) for t in texts])

    sample = map_columns(
        rows.select("_row", "_label", F.coalesce(F.col(text), F.lit(""))), "row long, label int, text string, content long", contents
    )
    sample = store(
        sample.groupBy("content", "label").agg(F.min_by(F.struct("row", "text"), "row").alias("s")).select("s.*", "label", "content"),
        "toxic-sample",
    )

    totals = sample.agg(F.count("*"), F.coalesce(F.sum((F.col("label") > 0).cast("int")), F.lit(0))).first()
    model = Model(new_folder(spark, "toxic-model"), totals[0], totals[1] / totals[0] if totals[0] else 0.0)

    def vectors():
        hashes = Hashes()

        def step(rows, labels, digests, texts):
            made = hashes.of_words(list(map(lower_words, texts)))
            return rows, labels, digests, [at.tolist() for at, _ in made], [often.astype(int).tolist() for _, often in made]

        return step

    # An example without a word is nobody's neighbour.
    made = map_columns(
        sample.select("row", "label", "content", "text"),
        "row long, label int, content long, terms array<long>, often array<int>", vectors,
    )
    made.filter("size(terms) > 0").write.parquet(f"{model.folder}/vectors")
    toxic = (F.col("label") > 0).cast("long")
    held = spark.read.schema(made.schema).parquet(f"{model.folder}/vectors").select(toxic.alias("toxic"), F.explode("terms").alias("term"))
    held.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).write.parquet(f"{model.folder}/terms")

    def left_out():
        model.loaded()

        def step(rows, texts):
            votes = [vote for vote, _ in model.votes(list(map(lower_words, texts)), rows)]
            return [[-1 if v < 0 else round(v * BINS) for v in votes]]

        return step

    votes = append_columns(sample.select("row", "text", "label"), ["row", "text"], "bin int", left_out)
    bins = votes.groupBy("bin").agg(F.count("*").alias("n"), F.sum((F.col("label") > 0).cast("int")).alias("y"))
    model.calibrate({r["bin"]: (r["n"], r["y"]) for r in bins.collect()})
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns, with _score (0 to 1) and _evidence (row key, cosine and label of
    the nearest examples). Texts without a word that an example has, null and empty ones
    among them, have no neighbour.
    No shuffle: workers read the model, bounded by ``MAX_LABELLED``, from the shared folder.
    """

    def start():
        index = model.loaded().index

        def step(texts):
            scores, evidence = [], []
            for made, near in model.scores(texts):
                scores.append(made)
                evidence.append(
                    [{"row": index.keys[r], "cosine": c, "label": int(index.labels[r])} for c, r in near]
                )
            return scores, evidence

        return step

    return append_columns(docs, [text], "_score double, _evidence array<struct<row:long,cosine:double,label:int>>", start)
