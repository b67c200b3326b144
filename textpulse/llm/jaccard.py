"""N-gram Jaccard join with Bayesian candidate pruning.

Texts with equal shingle sets are one node. MinHash bands bring nodes together into candidate
groups; inside a group, pairs that share a band compare their MinHash values a few at a time
and are dropped as soon as the posterior probability of a similarity of at least
``THRESHOLD`` falls below ``TOLERANCE``; the rest are verified on their exact shingle sets.
Large groups are cut into chunks and joined chunk by chunk, so no task holds a whole group.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpulse.llm.common import (
    append_columns, broadcast_if_small, lower_words, ready_workers, row_key, store,
)
from textpulse.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8

#: 32 bands of 4 values: a pair at 0.8 misses all of them with a probability below 1e-7.
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS

#: Values compared before each look at the posterior, and the probability below which a pair goes.
STEP, TOLERANCE = 16, 1e-7

#: A chunk of a group holds about this many nodes and characters at most.
CHUNK_NODES, CHUNK_CHARS = 512, 4 << 20

#: Shared-shingle tables up to this many cells are multiplied at once; else pair by pair.
DENSE_CELLS = 1 << 23

_random = np.random.default_rng(20240607)
_FACTORS = _random.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 1 << 63, HASHES, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word runs; of the whole if it has fewer words."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    made = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        made = (made ^ codes[k : k + len(made)]) * np.uint64(0x9E3779B97F4A7C15)
        made ^= made >> np.uint64(29)
    return np.unique(made)


def minhash(hashes: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        part = hashes[at : at + 2048, None]
        np.minimum(least, (part * _FACTORS + _SHIFTS).min(0), out=least)
    return least


def band_keys(values: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in values.reshape(BANDS, BAND_ROWS).T:
        keys = (keys ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


@cache
def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """The fewest equal values of n with which a pair stays.

    With a uniform prior the similarity has a Beta(m + 1, n - m + 1) posterior after m equal
    values; its upper tail from the threshold on is P(Binomial(n + 1, threshold) <= m).
    """
    tail = 0.0
    for m in range(n + 1):
        tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n


def prune(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``values`` that no look at the posterior drops."""
    equal = np.zeros(len(left), np.int64)
    for at in range(0, HASHES, STEP):
        equal += (values[left, at : at + STEP] == values[right, at : at + STEP]).sum(1)
        stay = equal >= least_matches(at + STEP, THRESHOLD, TOLERANCE)
        left, right, equal = left[stay], right[stay], equal[stay]
    return left, right


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of pairs of sorted sets."""
    if len(left) > 4 * len(sets):
        shared, counts = np.unique(np.concatenate(sets), return_counts=True)
        shared = shared[counts > 1]
        if len(sets) * len(shared) <= DENSE_CELLS:
            table = np.zeros((len(sets), len(shared)), np.float32)
            for row, one in enumerate(sets):
                at = np.searchsorted(shared, one)
                at[at == len(shared)] = 0
                table[row, at[shared[at] == one]] = 1
            return np.rint((table @ table.T)[left, right]).astype(np.int64)
    sizes = [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left.tolist(), right.tolist())]
    return np.array(sizes, np.int64)


def block_links(nodes: list[tuple[int, int, int, str]], cross: bool) -> list[tuple[int, int, int]]:
    """Links of one chunk, or across two: (node, least node linked with it in the block, links).

    ``nodes``: (chunk, node, documents of the node, text). Links count documents.
    """
    nodes = sorted({n[1]: n for n in nodes}.values(), key=lambda n: n[1])
    if len(nodes) < 2:
        return []
    sets = [shingles(n[3]) for n in nodes]
    values = np.array([minhash(s) for s in sets])
    keys = np.array([band_keys(v) for v in values])
    meet = np.zeros((len(nodes), len(nodes)), bool)
    for column in keys.T:
        order = np.argsort(column, kind="stable")
        edges = np.flatnonzero(np.diff(column[order])) + 1
        for group in np.split(order, edges):
            if len(group) > 1:
                meet[np.ix_(group, group)] = True
    if cross:
        chunk = np.array([n[0] for n in nodes])
        meet &= chunk[:, None] != chunk[None, :]
    left, right = np.nonzero(np.triu(meet, 1))
    left, right = prune(values, left, right)
    if not len(left):
        return []
    shared = overlaps(sets, left, right)
    sizes = np.array([len(s) for s in sets])
    alike = shared >= THRESHOLD * (sizes[left] + sizes[right] - shared) - 1e-9
    linked = np.zeros_like(meet)
    linked[left[alike], right[alike]] = True
    linked |= linked.T
    documents = np.array([n[2] for n in nodes])
    least = np.arange(len(nodes))
    while True:
        reach = np.where(linked, least[None, :], len(nodes)).min(1)
        now = np.minimum(least, reach)
        now = np.minimum(now, now[now])
        if (now == least).all():
            break
        least = now
    counts = linked @ documents
    return [(nodes[k][1], nodes[least[k]][1], int(counts[k])) for k in np.flatnonzero(linked.any(1)).tolist()]


def _block_runs(batches):
    """Links of every block of a partition that is sorted by (grp, i, j)."""
    schema = pa.schema([("node", pa.int64()), ("least", pa.int64()), ("links", pa.int64())])
    block, nodes = None, []

    def made(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], "int64") for k in range(3)], schema=schema
        )

    for batch in batches:
        columns = [batch.column(k) for k in range(7)]
        for row in range(batch.num_rows):
            here = tuple(columns[k][row].as_py() for k in range(3))
            if here != block:
                if len(nodes) > 1 and (rows := block_links(nodes, block[1] != block[2])):
                    yield made(rows)
                block, nodes = here, []
            nodes.append(tuple(columns[k][row].as_py() for k in range(3, 7)))
    if len(nodes) > 1 and (rows := block_links(nodes, block[1] != block[2])):
        yield made(rows)


def _signatures():
    def step(texts):
        nodes, bands = [], []
        for text in texts:
            found = shingles(text)
            if len(found):
                digest = xxhash.xxh3_64_intdigest(found.tobytes())
                nodes.append(digest - (1 << 64) if digest >= 1 << 63 else digest)
                bands.append(band_keys(minhash(found)).tolist())
            else:
                nodes.append(None)
                bands.append(None)
        return nodes, bands

    return step


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, nodes), both stored.

    ``rows``: (key, row, node) of every document; the node is the 64-bit digest of its shingle
    set, null without words. ``nodes``: (node, class_id, keep_row, keep_rows, n_links) of the
    nodes that have more than one document or a link: the least key of the class, the row of
    its first document (by key, nulls last) and how often that row is there, and the number
    of other documents each document of the node is linked to.
    """
    ready_workers(docs.sparkSession)
    narrow = docs.select(F.col(key).alias("key"), row_key(key, text).alias("row"), F.col(text).alias("text"))
    signed = store(
        append_columns(narrow, ["text"], "node long, bands array<long>", _signatures).drop("text"), "signatures"
    )
    rows = signed.select("key", "row", "node")
    banded = signed.filter("node IS NOT NULL").select(F.explode("bands").alias("band"), "node")
    # A bucket of one node joins nothing; equal texts collapse before the shuffle.
    buckets = banded.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z").drop("z")
    met = banded.join(buckets, "band").filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    groups = store(components(met), "candidate-groups")

    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "row"))
    per_node = store(
        rows.filter("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("n"), first.alias("first")), "nodes"
    )
    chosen = store(
        groups.join(per_node, "node").select("node", F.col("root").alias("grp"), "n", F.col("first.row").alias("row")),
        "members",
    )
    # A row that is there twice gives its node twice; blocks take it once.
    members = store(
        narrow.select("row", "text").join(broadcast_if_small(chosen, 48), "row").select("grp", "node", "n", "text"),
        "member-texts",
    )
    sizes = members.groupBy("grp").agg(F.count("*").alias("m"), F.sum(F.length("text")).alias("chars"))
    chunks = F.ceil(F.greatest(F.col("m") / CHUNK_NODES, F.col("chars") / CHUNK_CHARS)).cast("int")
    sizes = broadcast_if_small(store(sizes.select("grp", chunks.alias("chunks")), "group-sizes"), 24)
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    blocks = (
        members.join(sizes, "grp")
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "grp", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "node", "n", "text"
        )
    )
    linked = store(
        blocks.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
        .mapInArrow(_block_runs, "node long, least long, links long"),
        "block-links",
    )
    roots = components(linked.select(F.col("node").alias("a"), F.col("least").alias("b")))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    joined = (
        per_node.join(roots, "node", "left").join(links, "node", "left")
        .filter("n > 1 OR root IS NOT NULL")
        .withColumn("root", F.coalesce("root", "node"))
    )
    heads = joined.groupBy("root").agg(F.min("first").alias("head"))
    nodes = joined.join(heads, "root").select(
        "node", F.col("head.key").alias("class_id"), F.col("head.row").alias("keep_row"),
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    twice = rows.groupBy("row").agg(F.count("*").alias("keep_rows")).filter("keep_rows > 1")
    nodes = nodes.join(twice, nodes["keep_row"] == twice["row"], "left").select(
        "node", "class_id", "keep_row", F.coalesce("keep_rows", F.lit(1)).alias("keep_rows"), "n_links"
    )
    return rows, store(nodes, "classes")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, n_links) of every row.

    A document is linked to each other one whose set of 5-word shingles (of the whole text
    for fewer words) is ``THRESHOLD`` similar by Jaccard; a class is what links connect,
    named by its least key. Documents without words, null ones too, have no links and are
    their own class. Repeated rows are linked to each other.
    """
    rows, nodes = classes(docs, key, text)
    known = broadcast_if_small(nodes.select("node", "class_id", "n_links"), 48)
    return rows.join(known, "node", "left").select(
        F.col("key").alias(key), F.when(F.col("n_links").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each class: the one with the least key (nulls last)."""
    rows, nodes = classes(docs, key, text)
    fate = store(
        rows.join(nodes, "node").groupBy("row").agg(
            F.max(F.col("row") == F.col("keep_row")).alias("_stays"), F.max("keep_rows").alias("_times")
        ),
        "class-fates",
    )
    told = docs.withColumn("_row", row_key(key, text)).join(
        broadcast_if_small(fate.withColumnRenamed("row", "_row"), 32), "_row", "left"
    )
    own = [F.col(f"`{c}`") for c in docs.columns]
    once = F.coalesce("_stays", F.lit(True)) & (F.coalesce("_times", F.lit(1)) == 1)
    kept = told.filter(once).select(*own)
    if fate.filter("_stays AND _times > 1").isEmpty():
        return kept
    # Kept rows that are there several times, equal in key and text.
    turn = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
    again = told.filter("_stays AND _times > 1").withColumn("_turn", turn).filter("_turn = 1")
    return kept.unionByName(again.select(*own))
