"""Whitening, spelling variants and SimHash near-duplicates against brute force and on odd input."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textpulse.llm import simhash, variants, whitening
from textpulse.llm.common import table
from textpulse.llm.queries import QUERIES


# 11. Whitening

def symmetric(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    a = (q * values) @ q.T
    return (a + a.T) / 2


SPECTRA = {
    "spread": lambda d: np.random.default_rng(d).uniform(1, 100, d),
    "all tied": lambda d: np.full(d, 7.0),
    "six tied": lambda d: np.r_[[5.0] * min(d, 6), [1.0] * max(0, d - 6)],
    "fourth and fifth tied": lambda d: np.r_[[9.0, 8.0, 7.0, 6.0, 6.0], np.linspace(1, 2, d)][:d],
    "one": lambda d: np.r_[9.0, [0.0] * (d - 1)],
    "falling": lambda d: 1e4 * np.exp(-np.arange(d)),
    "close": lambda d: 1 + 1e-9 * np.arange(d),
}


@pytest.mark.parametrize("kind", SPECTRA)
@pytest.mark.parametrize("size", [1, 2, 5, 33, 120])
def test_components_are_eigenvectors(kind, size):
    a = symmetric(SPECTRA[kind](size), size)
    expected = np.linalg.eigvalsh(a)[::-1]
    scale = expected[0]
    for shift in np.random.default_rng(3).uniform(-1, 1.1 * scale, 8):
        assert whitening.count_above(a, shift) == (expected > shift).sum()
    values, vectors = whitening.components(a, 4)
    assert np.allclose(values, expected[:4], rtol=0, atol=1e-13 * size * scale)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * size * scale


@pytest.mark.parametrize("size", [16, 64, 200])
@pytest.mark.parametrize("gap", [1e-1, 1e-3, 1e-8])
def test_components_beside_a_crowd(size, gap):
    """Eigenvalues outside that nearly touch the wanted ones, far below the largest."""
    vectors, _ = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    expected = np.concatenate([[6.5, 2.1], 1.1 - gap * np.arange(size - 2) / size])
    a = (vectors * expected) @ vectors.T
    a = (a + a.T) / 2
    values, found = whitening.components(a, 4)
    assert values == pytest.approx(expected[:4], abs=1e-12)
    assert np.allclose(found.T @ found, np.eye(4), atol=1e-12)
    assert np.abs(a @ found - found * values).max() < 1e-12


def brute_whitened(vectors, wanted=4):
    x = np.array([[math.floor(256 * float(c)) for c in v] for v in vectors], dtype=object)
    fit = sorted({tuple(r) for r in x.tolist()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    f = np.array(fit, float)
    centred = f - f.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:wanted], axes[:, ::-1][:, :wanted]
    white = (x.astype(float) - f.mean(axis=0)) @ axes / np.sqrt(values)
    deviation = [sum((n * v - s) ** 2 for v, s in zip(r, sums)) for r in x.tolist()]
    return n, deviation, white, values / np.trace(centred.T @ centred / n)


def test_whitening_query(spark, small):
    rows = sorted(table(spark, small, "embeddings").collect(), key=lambda r: r["vec_id"])
    n, deviation, white, explained = brute_whitened([r["embedding"] for r in rows])
    made = QUERIES["op11_whitening"](spark, small)
    assert made.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [t for _, t in made.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    got = {(r["vec_id"], r["component"]): r for r in made.collect()}
    assert len(got) == 4 * len(rows)
    signs = np.sign([got[rows[0]["vec_id"], k + 1]["whitened"] * white[0][k] for k in range(4)])
    for i, r in enumerate(rows):
        for k in range(4):
            g = got[r["vec_id"], k + 1]
            assert (g["n"], g["deviation"]) == (n, deviation[i])
            assert g["whitened"] * signs[k] == pytest.approx(white[i][k], abs=1e-9)
            assert g["explained"] == pytest.approx(explained[k], rel=1e-9)
            assert g["identity_error"] < 1e-9


def test_whitening_counts_copies_once(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 7)).round(3).tolist()
    rows = [(i, v) for i, v in enumerate(base)] + [(100 + i, base[0]) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    n, deviation, white, _ = brute_whitened([v for _, v in rows])
    assert n == 40
    got = {r["vec_id"]: r["whitening"] for r in whitening.whiten(df).collect()}
    first = [w["whitened"] for w in got[0]]
    signs = np.sign(np.array(first) * white[0])
    for (key, _), d, w in zip(rows, deviation, white):
        assert [g["deviation"] for g in got[key]] == [d] * 4
        assert np.allclose([g["whitened"] for g in got[key]] * signs, w, atol=1e-9)


def test_whitening_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 2.0, 3.0], "x", 1), (1, [1.0, 2.0, 3.0], "x", 1), (None, [0.5, -1.0, 0.0], None, 2),
        (2, None, "x", 3), (3, [1.0, None, 2.0], "x", 3), (4, [nan, 1.0, 1.0], "x", 3), (5, [inf, 1.0, 1.0], "x", 3),
        (6, [], "x", 4), (7, [4.0], "x", 4), (8, [0.0, -0.0, -0.001], "x", 5), (9, [3e38, 1.0, 1.0], "x", 6),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x0 string, p int")
    made = whitening.whiten(df)
    assert made.columns == ["vec_id", "embedding", "x0", "p", "whitening"]
    got = made.collect()
    assert sorted(str(r["vec_id"]) for r in got) == ["1", "1", "6", "7", "8", "9", "None"]
    assert all(g["n"] == 6 for r in got for g in r["whitening"])
    assert {r["vec_id"]: r["whitening"][0]["deviation"] for r in got}[9] is None  # beyond 64 bits
    same = [r["whitening"] for r in got if r["vec_id"] == 1]
    assert same[0] == same[1]
    usual = whitening.whiten(df.filter("vec_id is null or vec_id < 9")).filter("vec_id = 7").first()["whitening"]
    assert [g["component"] for g in usual] == [1, 2, 3]  # three dimensions
    assert usual[0]["identity_error"] < 1e-9
    for few in (df.filter("false"), df.filter("vec_id = 1"), df.filter("vec_id = 6")):
        assert whitening.whiten(few).select(F.explode("whitening")).count() == 0


# 12. Spelling variants

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    counts = Counter()
    for key, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        run = ""
        for c in [*low, " "]:
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                word = run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[word] += len(word) >= 6
            run = ""
    counts = {w: n for w, n in counts.items() if n >= 5}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def test_variants_query_is_brute_force(spark):
    pick = random.Random(4)
    words = ["".join(pick.choice("abcdeéßÿ÷") for _ in range(pick.randint(6, 8))) for _ in range(40)]
    for w in list(words):  # near words of all three kinds, some of them near each other
        i = pick.randrange(len(w))
        words += [w[:i] + w[i + 1 :] + "ab"[len(w) > 6 :], w[:i] + pick.choice("abcdé") + w[i + 1 :], w[:i] + "a" + w[i:]]
    weights = [pick.choice([1, 1, 5, 30, 200]) for _ in words]
    rows = [(i, " ".join(pick.choices(words, weights, k=60)).title()) for i in range(400)]
    rows += [(None, " ".join(words)), (3, None), (4, ""), (3, rows[3][1])]
    rows += [(5, "chainaa " * 7 + "chainab " * 60 + "chainbb " * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in variants.group(docs).collect()}
    expected = brute_variants(rows)
    assert got == expected
    assert any(r[1] and r[2] != r[1] for r in expected)  # a chain of forms


def test_reduced_neighbourhoods_are_whole():
    symbols = 4
    for word in (b"", b"\x00", b"\x01\x01\x03", b"\x00\x01\x02\x03\x00\x00"):
        letters = [bytes([s]) for s in range(symbols)]
        near = {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}
        near |= {word[:i] + s + word[i + 1 :] for i in range(len(word)) for s in letters}
        near |= {word[:i] + s + word[i:] for i in range(len(word) + 1) for s in letters}
        assert sorted(variants.neighbourhood(word, symbols).tolist()) == sorted(variants.key_of(w) for w in near)
    assert [variants.symbols_for(n) for n in (0, 1 << 20, (1 << 20) + 1, 1 << 22, 1 << 40)] == [6, 6, 8, 10, 26]


def test_variants_do_not_depend_on_the_alphabet(spark, small, monkeypatch):
    docs = table(spark, small, "documents")
    usual = sorted(map(tuple, variants.group(docs).collect()), key=str)
    monkeypatch.setattr(variants, "symbols_for", lambda n: 2)
    assert sorted(map(tuple, variants.group(docs).collect()), key=str) == usual


def test_variants_of_odd_rows(spark, odd_docs):
    long = "ab" * 20_000
    more = spark.createDataFrame(
        [(i, f"{long} {long}c", "en", 0, 0, "x") for i in range(10, 20)],
        odd_docs.schema,
    )
    docs = odd_docs.unionByName(more).withColumnRenamed("n", "word").withColumnRenamed("row", "key")
    got = {r["word"]: r for r in variants.group(docs).collect()}
    assert got[long]["n_near"] == got[f"{long}c"]["n_near"] == 1
    assert got[long]["form"] is None and got[long]["root"] == long
    assert variants.group(odd_docs.filter("false")).count() == 0


# 13. SimHash

def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=2):
    prints = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    members = {}
    for i, (key, _) in enumerate(rows):
        members.setdefault(find(i), []).append(key)
    names = {k: min((m for m in v if m is not None), default=None) for k, v in members.items()}
    return Counter((key, f"{p:016x}", names[find(i)]) for i, ((key, _), p) in enumerate(zip(rows, prints)))


def test_simhash_query_is_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, small, "documents").collect()]
    made = QUERIES["op13_simhash"](spark, small)
    assert made.columns == ["doc_id", "fingerprint", "component_id"]
    got = Counter(map(tuple, made.collect()))
    assert got == brute_components(rows)
    assert any(key != name for key, _, name in got)


def test_simhash_links_chains(spark):
    """Fingerprints that differ by 0 to 4 bits: linked up to two, and through each other."""
    pick = random.Random(8)
    base = [pick.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for b in base:
        at = b
        for _ in range(pick.randrange(8)):
            for _ in range(pick.choice([1, 2, 3, 4])):
                at ^= 1 << pick.randrange(64)
            prints.add(at)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    for radius in (0, 2, 4):
        found = simhash.components(simhash.links(df, radius)).collect() if radius else []
        groups = {r["node"]: r["root"] for r in found}
        for i, a in enumerate(signed):
            for b in signed[:i]:
                if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius:
                    assert groups[a] == groups[b]
        assert simhash.links(df, radius).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > radius).count() == 0
    with pytest.raises(ValueError):
        simhash.links(df, 3)


def test_long_texts_are_hashed_whole(monkeypatch):
    pick = random.Random(2)
    text = "".join(pick.choice(["ab", "É", "x" * 40, " ", "\n\t", "\x0b ", "\x85"]) + " " * pick.randrange(2) for _ in range(3000))
    expected = brute_fingerprint(text)
    for size in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(simhash, "PIECE_BYTES", size)
        assert simhash.fingerprint(text) & ((1 << 64) - 1) == expected


def test_simhash_odd_rows(spark, odd_docs):
    docs = odd_docs.withColumnRenamed("n", "fp").withColumnRenamed("row", "root").withColumnRenamed("node", "id")
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = Counter(map(tuple, simhash.near_duplicates(docs).collect()))
    assert got == brute_components(rows)
    assert got[3, "0" * 16, 3] == got[4, "0" * 16, 3] == got[None, "0" * 16, 3] == 1
    assert simhash.near_duplicates(docs.filter("false")).count() == 0
    assert simhash.near_duplicates(docs.filter("doc_id is null and text is null")).first()[2] is None


# Columns of the operators' own names

def test_line_dedup_keeps_columns_of_any_name(spark):
    from textpulse.llm import lines

    line = "a line that is long enough to be compared with others"
    rows = [(1, f"{line}\nfirst", 7, [1], 9, 5, "x", 3), (2, f"{line}\nsecond", 8, [2], 9, 6, "y", 4)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, removed int, classes array<int>, n_links int, _row int, h1 string, _n_lines int"
    )
    made = lines.dedup_lines(docs)
    assert made.columns == [*docs.columns[:-1], "_n_lines", "_n_links", "_line_classes", "_n_removed"]
    got = {r["doc_id"]: r for r in made.collect()}
    assert got[1]["text"] == rows[0][1] and got[2]["text"] == "second"
    for row in rows:
        assert tuple(got[row[0]])[2:7] == row[2:7]
    assert [got[k]["_n_removed"] for k in (1, 2)] == [0, 1] and got[1]["_n_links"] == 1
