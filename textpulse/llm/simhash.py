"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``2 h`` bits have a fingerprint within ``h`` bits of both. So every distinct
fingerprint emits all variants within ``h`` bits, equal variants meet in a shuffle, and
fingerprints that meet are linked once their distance is verified. At most as many
fingerprints meet under a variant as one emits (65 for one bit), whatever the data.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; a text of
one or two words is one shingle; repeated rows are one node and each keeps its row; null ids keep their
row and never name a component unless it has no other id; other columns are not read. An empty table
gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpulse.llm.common import map_columns, store
from textpulse.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
BITS = 64
RADIUS = 2
#: Bytes of text split into words at a time; bounds what a very long text holds.
PIECE_BYTES = 1 << 20
#: Hashes whose bits are counted at a time.
COUNTED = 1 << 14
_SPACE = b" \t\n\r\x0b\x0c"


def _pieces(data: bytes):
    """``data`` in pieces that end where a word ends; their words are the words of ``data``."""
    at = 0
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        yield data[at:end]
        at = end


def _hashes(text: str | None):
    """Hashes of all word shingles of the text, in lists."""
    digest = xxhash.xxh64_intdigest
    words: list[bytes] = []
    found = False
    for piece in _pieces((text or "").encode().lower()):  # bytes: A-Z alone, ASCII spaces alone
        words += piece.split()
        if len(words) >= SHINGLE_WORDS:
            found = True
            yield [digest(b" ".join(w), SEED) for w in zip(*(words[k:] for k in range(SHINGLE_WORDS)))]
            words = words[1 - SHINGLE_WORDS :]
    if words and not found:
        yield [digest(b" ".join(words), SEED)]


def fingerprint(text: str | None) -> int:
    """A bit is 1 if it is set in over half of the text's shingle hashes, repeats included."""
    ones, total = np.zeros(BITS, np.int64), 0
    for hashes in _hashes(text):
        total += len(hashes)
        values = np.array(hashes, "<u8")
        for at in range(0, len(values), COUNTED):
            part = np.unpackbits(values[at : at + COUNTED].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fingerprint as a signed long), one row per row; no shuffle."""

    def start():
        return lambda ids, texts: [ids, [fingerprint(t) for t in texts]]

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_columns(rows, f"id {rows.schema['id'].dataType.simpleString()}, fp long", start)


def ball(bits: int) -> list[int]:
    """Masks, as signed longs, of all ways to flip up to ``bits`` bits."""
    masks = [sum(1 << b for b in flips) for k in range(bits + 1) for flips in combinations(range(BITS), k)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) of fingerprints ``fp`` within ``radius`` bits: enough to connect all that are.

    Those that meet under a variant are all within ``radius`` of each other, so each is linked to the
    least of them: the same components as from all pairs.
    """
    if radius % 2 or not 0 <= radius < BITS:
        raise ValueError("the radius is an even number of bits")
    masks = F.array(*(F.lit(m) for m in ball(radius // 2)))
    variants = distinct.select("fp", F.explode(masks).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant")
    )
    least = F.min("fp").over(Window.partitionBy("variant"))
    met = variants.select(F.col("fp").alias("a"), least.alias("b")).filter("a <> b").distinct()
    return met.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(id column, fingerprint, component_id) of every row; the component's name is its least id.

    Fingerprints are worked out once and stored; texts are never shuffled.
    """
    rows = store(fingerprints(docs, id_column, text_column), "fingerprints")
    distinct = store(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    found = components(links(distinct, radius))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = store(rooted.join(names, "root").select("fp", "component_id"), "named")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(named, "fp").select(F.col("id").alias(id_column), hexed.alias("fingerprint"), "component_id")
