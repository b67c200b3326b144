"""Each operator against a brute-force version and on odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textpulse.llm import bpe, common, components, decontaminate, html_tree, jaccard, licenses, lines, quality, sharding, toxicity, urls
from textpulse.llm.common import table
from textpulse.llm.queries import QUERIES, vocabulary_path

WORDS = [a + b for a in "ba de fi go hu ja ke li mo nu".split() for b in "ra se ti po lu".split()]


def some_text(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) for _ in range(n))


def empty(df):
    return df.filter("false")


# 1. BPE

def library():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(vocabulary_path())
    made.no_padding()
    made.no_truncation()
    return made


@pytest.mark.parametrize("text", [
    "", " \n\t", "Hello  World's don't 123", "ünïcode ΑΣ İ ß ﬁ", "<|endoftext|>x<|startoftext|> <|EndOfText|>",
    "日本語 😀👍🏽", "a​b c d", "!!??...,,,", "ab" * 3000, "½²Ⅷ٣",
])
def test_bpe_is_the_library(text):
    own = bpe.Encoder(open(vocabulary_path(), encoding="utf-8").read())
    expected = library().encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), "<u4").tolist() == expected
    assert own.decode(own.encode(text)) == library().decode(expected, skip_special_tokens=False)


def test_bpe_query_on_whole_table(spark, small):
    made = {r["doc_id"]: r for r in QUERIES["op1_bpe"](spark, small).collect()}
    theirs = library()
    for r in table(spark, small, "documents").collect():
        ids = theirs.encode(r["text"], add_special_tokens=False).ids
        assert made[r["doc_id"]]["n_tokens"] == len(ids)
        assert made[r["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = theirs.decode(ids, skip_special_tokens=False)
        assert made[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_odd_rows_and_arrays(spark, odd_docs):
    assert bpe.round_trip(odd_docs, vocabulary_path()).count() == 8
    ids = bpe.encode(odd_docs, vocabulary_path())
    texts = {r["doc_id"]: r["text"] for r in bpe.decode(ids, vocabulary_path()).collect()}
    assert texts[4] == "" and texts[2].startswith("one</w> two</w>")
    assert bpe.round_trip(empty(odd_docs), vocabulary_path()).count() == 0


# 2. Sharding

def test_flow_moves_the_fewest_bytes():
    pick = random.Random(5)
    for _ in range(30):
        old = [pick.randint(0, 50) for _ in range(pick.randint(1, 6))]
        m = pick.randint(1, 6)
        new = sharding.near_equal(sum(old), m)
        flow = sharding.cheapest_flow(old, new, [[int(i != j) for j in range(m)] for i in range(len(old))])
        assert [sum(r) for r in flow] == old and [sum(c) for c in zip(*flow)] == new
        stay = sum(flow[i][i] for i in range(min(len(old), m)))
        assert stay == sum(min(a, b) for a, b in zip(old, new))


def test_flow_with_costs_matches_brute_force():
    cost = [[4, 1, 3], [2, 5, 2]]
    flow = sharding.cheapest_flow([2, 2], [1, 2, 1], cost)
    best = min(
        sum(cost[i][j] * f[i][j] for i in range(2) for j in range(3))
        for a in range(2) for b in range(3) for f in [[[a, b, 2 - a - b], [1 - a, 2 - b, 1 - (2 - a - b)]]]
        if all(x >= 0 for r in f for x in r)
    )
    assert sum(cost[i][j] * flow[i][j] for i in range(2) for j in range(3)) == best


def test_flow_needs_room():
    with pytest.raises(ValueError):
        sharding.cheapest_flow([3], [2], [[0]])


def test_reshard_query(spark, small):
    rows = QUERIES["op2_reshard"](spark, small).collect()
    docs = {r["doc_id"]: r["text"] for r in table(spark, small, "documents").collect()}
    assert len(rows) == len(docs)
    load, slots = Counter(), {}
    for r in rows:
        body = docs[r["doc_id"]].encode()
        assert r["size"] == len(body) + 1 and r["text_crc32"] == zlib.crc32(body)
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    longest = max(r["size"] for r in rows)
    assert max(load.values()) - sum(load.values()) / 16 < 4 * longest


def test_reshard_odd_rows_and_rewrite(spark, odd_docs, tmp_path):
    placed = sharding.place(odd_docs, F.lit(0), 2).cache()
    assert placed.count() == 8 and sharding.place(empty(odd_docs), F.lit(0), 2).count() == 0
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    sharding.write_blocks(odd_docs, placed, old)
    where = sharding.rewrite_affected(spark, placed, old, new).collect()
    assert sum(r["rows"] for r in where) == 8
    read = sum(spark.read.parquet(f).count() for f in {r["folder"] for r in where})
    assert read == 8


def test_rewrite_of_equal_rows_in_two_old_shards(spark, tmp_path):
    rows = [(1, "same", 0), (1, "same", 1), (1, "same", 1), (2, "other", 0), (3, "more words", 1), (4, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source int")
    placed = sharding.place(docs, F.col("source"), 2).cache()
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    with pytest.raises(ValueError):
        sharding.write_blocks(docs, placed, str(tmp_path / "none"))
    sharding.write_blocks(docs, placed, old, old_shard=F.col("source"))
    written = spark.read.parquet(old)
    assert sorted((r["doc_id"], r["source"], r["old_shard"]) for r in written.collect()) == sorted((k, s, s) for k, _, s in rows)
    where = sharding.rewrite_affected(spark, placed, old, new).collect()
    assert sum(spark.read.parquet(f).count() for f in {r["folder"] for r in where}) == len(rows) == sum(r["rows"] for r in where)


# 3. Toxicity

def test_nearest_is_exact():
    pick = random.Random(2)
    vectors = []
    for _ in range(300):
        raw = {pick.randrange(12): pick.random() for _ in range(pick.randint(1, 4))}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        vectors.append({k: v / norm for k, v in raw.items()})
    index = toxicity.Index(vectors, [0] * 300, list(range(300)), 12)
    for q in range(0, 300, 17):
        dots = [(round(sum(w * v.get(t, 0) for t, w in vectors[q].items()), 12), -r) for r, v in enumerate(vectors) if r != q]
        expected = [(c, -r) for c, r in sorted(dots, reverse=True)[:15] if c > 0]
        got = index.nearest(vectors[q], 15, leave=q)
        assert [round(c, 9) for c, _ in got] == [round(min(1, c), 9) for c, _ in expected]


def test_nearest_is_exact_on_texts_and_skips_blocks(spark):
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    held = model.loaded()
    index = held.index
    whole = np.zeros((index.n, len(held.terms)))
    for r in range(index.n):
        part = slice(index.edges[r], index.edges[r + 1])
        whole[r, index.places[part]] = index.often[part] * held.weights[index.places[part]]
    whole /= np.linalg.norm(whole, axis=1, keepdims=True)
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(500).collect()]
    vectors = [held.vector(t) for t in texts]
    for (at, weights), got in zip(vectors, index.nearest_each(vectors, 15, [None] * len(vectors))):
        cosines = whole[:, at] @ weights
        assert [c for c, _ in got] == pytest.approx(sorted(cosines[cosines > 1e-12], reverse=True)[:15], abs=1e-9)
        assert [cosines[r] for _, r in got] == pytest.approx([c for c, _ in got], abs=1e-9)
    assert index.blocks_opened < 0.8 * index.blocks_met


def test_toxicity_terms_of_long_words_and_remembered_ones():
    hashes = toxicity.Hashes(most=3)
    texts = ["abcdefgh abcdefgh abcde xyz", "", None, "one two three four five six seven eight", "abcdefgh abcdefgh abcde xyz"]
    made = [hashes.counts(t) for t in texts]
    # abcdefgh twice, its starts of 5 and 6 twice, abcde, the shared start of 4 three times, xyz.
    assert sorted(made[0][1].tolist()) == [1, 1, 2, 2, 2, 3]
    assert len(made[1][0]) == len(made[2][0]) == 0
    assert all((a == b).all() for a, b in zip(made[0], made[4]))


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op3_toxicity"](spark, folder).collect()
    truth = {r["doc_id"]: r["toxic"] for r in table(spark, folder, "labels").collect()}
    assert len(rows) == table(spark, folder, "documents").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.9


def test_toxicity_without_labels(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.score(odd_docs, toxicity.fit(odd_docs, labels))
    assert scored.columns[: len(odd_docs.columns)] == odd_docs.columns
    assert [r["_score"] for r in scored.collect()] == [0.0] * 8
    nulls = spark.createDataFrame([(None, 1), (1, None), (1, 1), (1, 0), (3, 0)], "doc_id long, toxic int")
    assert toxicity.score(odd_docs, toxicity.fit(odd_docs, nulls)).count() == 8


def test_toxicity_keeps_rare_marks_and_unmarked_examples(spark):
    pick = random.Random(5)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(4))
    usual = [word() for _ in range(30)]
    text = lambda extra: " ".join(extra + pick.sample(usual, 12))
    ids = [k for k in range(700) if zlib.crc32(str(k).encode()) % 5]
    # Of 200 toxic examples, three hold a mark of their own: 1.5%.
    rows = [(k, text(["vile"] if j >= 3 else ["zorgish"]), 1) for j, k in enumerate(ids[:200])]
    rows += [(k, text([]), 0) for k in ids[200:500]]
    asked = [(1000, text(["zorgish"]), None), (1001, text([]), None), (1002, "unheard", None), (1003, "", None)]
    docs = spark.createDataFrame(rows + asked, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"))
    assert len(model.examples[0]) == 500
    scored = {r["doc_id"]: r for r in toxicity.score(docs, model).collect() if r["doc_id"] >= 1000}
    assert scored[1000]["_score"] >= 0.5 and scored[1000]["_evidence"][0]["label"] == 1
    assert scored[1001]["_score"] < 0.5 and len(scored[1001]["_evidence"]) == 3
    assert scored[1002]["_evidence"] == [] == scored[1003]["_evidence"]


def test_toxicity_merges_equal_examples_only(spark):
    # The first run of five words is shared, and the rest differs.
    rows = [(k, "aa bb cc dd ee" + (f" own{k}" if k % 2 else ""), 1) for k in range(1, 40) if zlib.crc32(str(k).encode()) % 5]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"))
    assert len(model.examples[0]) == len({t for _, t, _ in rows})


def test_toxicity_places_are_those_of_the_hashes():
    texts = ["abcdefgh abcdefgh abcde xyz", "one two three four five six seven eight", "", "abcdefgh unheard xyz"]
    terms = np.unique(np.concatenate([toxicity.Hashes().counts(t)[0] for t in texts[:2]]))
    held = toxicity.Hashes(most=3, terms=terms)
    for text in texts * 2:
        hashes, often = toxicity.Hashes().counts(text)
        at, times = held.counts(text)
        known = np.isin(hashes, terms)
        assert terms[at[at < len(terms)]].tolist() == hashes[known].tolist()
        assert times[at < len(terms)].tolist() == often[known].tolist()
        assert sorted(times[at >= len(terms)]) == sorted(often[~known])


def test_toxicity_hashes_many_texts_at_a_time():
    # Per text the terms that a plain count has, whatever else is in the batch; a start is not the word spelt like it.
    texts = ["abcdefgh abcdefgh abcde abcd", "", "größer größe ab\ud800cdef 東京都庁舎", "abcd", "abcd " + "x" * 5000]
    words = [common.lower_words(t) for t in texts]
    for most in (1, 40, 1 << 18):
        made = toxicity.Hashes(most=most).of_words(words)
        for each, (hashes, often) in zip(words, made):
            plain = Counter(t for w in each for t in [w, *(w[:k] + "-" for k in toxicity.STARTS if len(w) > k)])
            assert (np.diff(hashes) > 0).all() and sorted(often) == sorted(plain.values())
            for word in each:
                assert set(toxicity.Hashes().counts(word)[0]) <= set(hashes)
        # abcd is a word in texts 0 and 3, and a start in text 0 alone.
        assert len(set(made[0][0]) & set(made[3][0])) == len(made[3][0]) == 1


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_toxicity_places_are_found_as_by_search(n):
    pick = np.random.default_rng(n)
    for values in (np.unique(pick.integers(-(2**63), 2**63 - 1, n)), np.arange(n), np.array([-(2**63), 2**63 - 1])):
        wanted = np.concatenate([values, pick.integers(-(2**63), 2**63 - 1, 500), [-(2**63), -1, 0, 1, 2**63 - 1]])
        assert (toxicity.Places(values).of(wanted) == np.searchsorted(values, wanted)).all()


def test_toxicity_opens_an_example_once_for_all_texts(monkeypatch):
    pick = np.random.default_rng(4)
    # Terms of every frequency, and a few examples that are much longer than the others.
    share = np.geomspace(0.004, 0.3, 300)
    vectors = []
    for r in range(640):
        at = np.flatnonzero(pick.random(300) < (3 * share if r % 20 == 0 else share))
        raw = pick.random(len(at)) + 0.1
        vectors.append({int(t): float(w) for t, w in zip(at, raw / np.linalg.norm(raw))} if len(at) else {0: 1.0})
    index = toxicity.Index(vectors, [0] * 640, list(range(640)), 300)
    assert index.n_long == 5 and index.n_common and index.long.any() and index.tops.any()
    whole = np.zeros((640, 300))
    for r, v in enumerate(vectors):
        whole[r, list(v)] = list(v.values())
    opened = []
    plain = toxicity.Index._open
    monkeypatch.setattr(toxicity.Index, "_open", lambda self, row, begin: (opened.append(row) if begin else None, plain(self, row, begin)))
    queries = [(np.array(list(v), np.int64), np.array(list(v.values()))) for v in vectors[::3]]
    for (at, weights), got in zip(queries, index.nearest_each(queries, 15, [None] * len(queries))):
        cosines = whole[:, at] @ weights
        assert [c for c, _ in got] == pytest.approx(sorted(cosines[cosines > 1e-12], reverse=True)[:15], abs=1e-9)
        assert [cosines[r] for _, r in got] == pytest.approx([c for c, _ in got], abs=1e-9)
    assert len(opened) == len(set(opened))


def test_toxicity_index_packs_postings():
    # One number for a place and its weight: rounded up, by less than a step.
    pick = np.random.default_rng(3)
    vectors = [{int(t): float(w) for t, w in zip(pick.choice(400, 9, False), pick.random(9))} for _ in range(500)]
    index = toxicity.Index(vectors, [0] * 500, list(range(500)), 400)
    assert index.rare.dtype == np.int32 and len(index.rare) + len(index.middle) == 4500
    for t in range(0, 400, 7):
        found = index.rare[index.begins[t] : index.begins[t] + index.sizes[t]]
        for spot, weight in zip((found >> 16).tolist(), (found & toxicity.FINE).tolist()):
            v = vectors[index.row_at[spot]]
            exact = v[t] / np.linalg.norm(list(v.values()))
            assert -1e-6 <= weight / toxicity.FINE - exact < 1.01 / toxicity.FINE + 1e-6


def test_workers_let_go_of_what_other_tasks_held(monkeypatch):
    held = common.Held()
    made = []

    def make():
        made.append(1)
        return "index"

    def asks():
        held.get("a", make)
        return lambda: None

    for _ in range(2):
        with held.task(asks):
            held.drop()
            assert held.made == "index"
    assert len(made) == 1
    with held.task(lambda: None):
        assert held.made is None
    monkeypatch.setattr(common, "IDLE_SECONDS", 0.01)
    with held.task(asks):
        assert held.made == "index"
    held._timer.join(10)
    assert held.made is None


# 4. Quality

def test_quality_base_counts(spark, small):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    docs = {r["doc_id"]: r["text"] for r in table(spark, small, "documents").collect()}
    for r in QUERIES["op4_quality"](spark, small).collect():
        text = docs[r["doc_id"]]
        words = word.findall(text)
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {k + d for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for d in range(3)}
        split = [x for x in text.split("\n") if word.search(x)]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["n_dup_lines"] == len(split) - len(set(split))
        assert r["n_repeat_words"] == len(again)
        assert r["base_failed"] == (len(words) < 50 or 100 * len(again) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_quality_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in table(spark, folder, "labels").collect()}
    judged = [r for r in QUERIES["op4_quality"](spark, folder).collect() if not r["base_failed"] and r["doc_id"] in truth]
    assert sum(r["kept"] == bool(truth[r["doc_id"]]) for r in judged) / len(judged) > 0.97


def test_js_distance_bounds():
    p = np.array([1.0, 0, 3])
    assert quality.js_distance(p, p * 2) == 0
    assert quality.js_distance(np.array([1.0, 0]), np.array([0, 5.0])) == pytest.approx(1)


def test_quality_odd_rows(spark, odd_docs):
    assert quality.judge(odd_docs).count() == 8 and quality.judge(empty(odd_docs)).count() == 0


def test_quality_minority_languages(spark):
    pick = random.Random(6)
    speak = lambda letters, n: " ".join(
        "".join(pick.choice(letters) for _ in range(2)) for _ in range(n)
    )
    rows = [(k, "xx", speak("abcdef", 400)) for k in range(700)]
    # 0.4% of all words, in a script of its own, and a language without enough of them.
    rows += [(1000 + k, "yy", speak("жзиклм", 100)) for k in range(11)] + [(2000, "zz", speak("αβγδεζ", 90)), (2001, None, speak("αβγδεζ", 90))]
    rows += [(3000, "yy", "#$%& " * 25 + speak("0123456789", 60))]
    judged = quality.judge(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()
    made = {r["doc_id"]: r for r in judged}
    assert all(made[1000 + k]["kept"] and made[1000 + k]["nearest"] == "yy" for k in range(11))
    assert made[2000]["kept"] and made[2001]["kept"] and not made[3000]["kept"]


# 5. Decontamination

def test_leaks_against_every_window(spark):
    items = [(1, some_text(1, 30)), (2, some_text(2, 18)), (3, "two words"), (None, "x"), (4, None), (5, "  ")]
    docs = []
    for k in range(40):
        pick = random.Random(k)
        inner = items[k % 2][1].split()
        for _ in range(k % 5):
            inner[pick.randrange(len(inner))] = "other"
        docs.append((k, some_text(100 + k, 12) + " " + " ".join(inner) + " " + some_text(200 + k, 9)))
    docs += [(100, None), (101, ""), (102, "two words"), (103, items[1][1][:40])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {
        (r["doc_id"], r["item_id"]): r["similarity"]
        for r in decontaminate.find_leaks(frame, bench).select("doc_id", F.inline("_leaks")).collect()
    }
    for k, text in docs:
        words = (text or "").split()
        for item, body in items[:3]:
            own = body.split()
            width, size = min(5, len(own)), min(len(own), len(words))
            theirs = Counter(zip(*(own[j:] for j in range(width))))
            best = 0.0
            for at in range(len(words) - size + 1):
                mine = Counter(zip(*(words[at : at + size][j:] for j in range(width))))
                both = sum((mine & theirs).values())
                best = max(best, both / max(1, sum((mine | theirs).values())))
            assert ((k, item) in got) == (best >= 0.8)
            if best >= 0.8:
                assert got[k, item] == pytest.approx(best)


def test_leaks_of_close_copies(spark):
    items = [(1, some_text(1, 30)), (2, "two words")]
    body, cut = items[0][1], " ".join(items[0][1].split()[:-1] + ["other"])
    docs = [
        (1, f"{body} {body}"), (2, f"{body} {some_text(7, 3)} {cut} {body}"), (3, body), (4, "two words two words"),
        (5, f"{some_text(8, 9)} {body} {some_text(9, 9)}"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in decontaminate.find_leaks(frame, bench).select("doc_id", F.inline("_leaks")).collect():
        got.setdefault(r["doc_id"], []).append((r["item_id"], r["start"]))
    # The window a word before the cut copy is as similar, and comes first.
    assert got == {1: [(1, 0), (1, 30)], 2: [(1, 0), (1, 32), (1, 63)], 3: [(1, 0)], 4: [(2, 0), (2, 2)], 5: [(1, 9)]}


def test_block_tables_find_all_in_the_radius():
    items = decontaminate.Items([(k, some_text(k, 20)) for k in range(60)])
    pick = random.Random(1)
    for k in range(60):
        near = items.whole[k]
        for bit in pick.sample(range(64), decontaminate.RADIUS):
            near ^= 1 << bit
        expected = [i for i, p in enumerate(items.whole) if (p ^ near).bit_count() <= decontaminate.RADIUS]
        assert items.within(near) == expected and k in expected


def test_leaks_odd_rows(spark, odd_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(odd_docs, nothing).filter("size(_leaks) > 0").count() == 0
    bench = spark.createDataFrame([(7, "one two three four five six")], "item_id long, text string")
    found = decontaminate.find_leaks(odd_docs, bench)
    assert found.columns[:-1] == odd_docs.columns and found.filter("size(_leaks) = 1").count() == 3


# 6. Jaccard join

def brute_classes(rows):
    sets = [frozenset(jaccard.shingles(t).tolist()) for _, t in rows]
    links = [[j for j, b in enumerate(sets) if i != j and a and len(a & b) >= 0.8 * len(a | b) - 1e-9] for i, a in enumerate(sets)]
    head = list(range(len(rows)))
    for _ in rows:
        head = [min([head[i], *(head[j] for j in links[i])]) for i in range(len(rows))]
    members = {}
    for i, h in enumerate(head):
        members.setdefault(h, []).append(rows[i][0])
    return Counter(
        (k, min((m for m in members[h] if m is not None), default=None), len(links[i])) for i, ((k, _), h) in enumerate(zip(rows, head))
    )


def near_rows():
    rows = []
    for k in range(120):
        words = some_text(k % 12, 90).split()
        pick = random.Random(k)
        for _ in range(pick.randint(0, 3)):
            words[pick.randrange(90)] = f"new{k}"
        rows.append((k, " ".join(words)))
    return rows + [(500, None), (501, ""), (502, "a b"), (503, "A, b"), (None, "a b"), (502, "a b")]


@pytest.mark.parametrize("nodes", [512, 7])
def test_join_against_all_pairs(spark, monkeypatch, nodes):
    monkeypatch.setattr(jaccard, "CHUNK_NODES", nodes)
    rows = near_rows()
    made = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in made) == brute_classes(rows)


def test_keep_one(spark, odd_docs):
    rows = near_rows()
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = brute_classes(rows)
    assert {r["doc_id"] for r in kept} == {c for _, c, _ in expected}
    assert jaccard.keep_one(odd_docs).columns == odd_docs.columns
    assert jaccard.keep_one(odd_docs).count() == 6 and jaccard.keep_one(empty(odd_docs)).count() == 0


def test_posterior_bound():
    for n in (16, 64, 128):
        m = jaccard.least_matches(n, 0.8, 1e-7)
        tail = lambda m: sum(math.comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m + 1))
        assert tail(m) >= 1e-7 and (m == 0 or tail(m - 1) < 1e-7)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert roots == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


# 7. Licenses

def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES:
        sought = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(sought)] == sought:
                starts.append(k)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_license_base(spark):
    odd = [(-1, None), (-2, ""), (-3, " ,.\n"), (-4, "CC BY-NC cc by nc under the MIT License under the mit license"),
           (-5, "Apache License, Version 2.0; ünder the MIT license"), (-6, "cc by nc")]
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in licenses.scan(docs).collect():
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        assert got == brute_base(texts[r["doc_id"]])
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"]


def test_license_priority_and_containment(spark):
    texts = ["gnu general public license version 3", "gpl", "licensed under the terms of the Mozilla Public License v2.0", "Mit license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert found[0]["labels"] == "gpl-3" and [tuple(d)[:2] for d in found[0]["detections"]] == [(0, 6)]
    assert found[1]["labels"] == "" and found[2]["labels"] == "mpl-2" and found[3]["labels"] == "mit"
    assert found[0]["score"] == 1.0 and len(licenses.signature_rules()) > 200


def sample_matches(pattern):
    """Texts that a signature pattern matches: each of its alternatives and options, shortest and longest."""
    from re import _parser

    def made(parsed):
        texts = [""]
        for kind, value in parsed:
            name = str(kind)
            if name == "LITERAL":
                more = [chr(value)]
            elif name == "IN":
                more = [chr(v if str(k) == "LITERAL" else v[0]) for k, v in value]
            elif name == "BRANCH":
                more = [x for branch in value[1] for x in made(branch)]
            elif name == "SUBPATTERN":
                more = made(value[3])
            else:
                assert name == "MAX_REPEAT" and value[:2] == (0, 1)
                more = ["", *made(value[2])]
            texts = [a + b for a in texts for b in more]
        return texts

    found = sorted(set(made(_parser.parse(pattern))), key=len)
    assert all(re.fullmatch(pattern, x) for x in found)
    return found


def test_license_gates_accept_what_rules_match(spark):
    for _, _, keyword, pattern in licenses.signature_rules():
        assert all(keyword in x.split() for x in sample_matches(pattern)), (keyword, pattern)
    texts = [
        "licensed under the Expat license", "Neither the name of the copyright holder", "GPLv3", "GNU GPLv2 or later", "LGPLv2.1",
        "released under the AGPLv3", "gplv3.0", "LGPL2.1+", "lgplv3", "GPL3",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    labels = ["mit", "bsd-3-clause", "gpl-3", "gpl-2", "lgpl-2.1", "agpl-3", "gpl-3", "lgpl-2.1", "lgpl-3", "gpl-3"]
    assert [found[k]["labels"] for k in range(len(texts))] == labels
    assert all(found[k]["score"] > 0 for k in found)


# 8. HTML

def test_html_blocks_and_furniture():
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><a>menu</a></nav>"
        "<header>top</header><div class='cookie-notice'>accept</div><main><article><h1>A &amp; B</h1><p>one<br>two <b>three"
        "<p>four&nbsp;five<ul><li>x<li>y</ul><script>var a='</p>'</script><section id=comments><p>me too</p></section></article></main>"
        "<aside>side</aside><footer>end</footer>"
    )
    assert html_tree._wanted(html_tree.blocks(page), set()) == "A & B\none two three\nfour five\nx\ny"
    assert html_tree._wanted(html_tree.blocks(""), set()) == ""


def test_html_low_branch_goes(spark):
    rows = [(k, f"http://h.org/{k}", f"<body><div class=zz>same words</div><div class=yy><p>{some_text(k, 30)}</p></div>") for k in range(20)]
    rows += [(50, None, None), (51, "http://h.org/", ""), (52, "x", "<p>alone</p>")]
    made = {r["k"]: r["_text"] for r in html_tree.extract(spark.createDataFrame(rows, "k int, url string, html string")).collect()}
    assert all(made[k] == some_text(k, 30) for k in range(20))
    assert made[50] == "" and made[51] == "" and made[52] == "alone"


def test_html_copies_are_no_evidence(spark):
    rows = [(k, f"http://h.org/{k}", f"<body><div class=yy><p>{some_text(k, 400)}</p></div>") for k in range(20)]
    # One article under many URLs: a template of its own, and a table in an article with a changing side.
    own, table_ = "<div class=post><p>the whole text of it</p></div>", "<article><p>told</p><table><tr><td>in cells</table></article>"
    rows += [(100 + k, f"http://h.org/own?utm={k}", f"<body>{own}") for k in range(20)]
    rows += [(200 + k, f"http://h.org/two?ref={k}", f"<body><div class=side>{some_text(900 + k, 5)}</div>{table_}") for k in range(20)]
    # The same words in different articles still go.
    rows += [(300 + k, f"http://h.org/a{k}", f"<body><article><p class=zz>same words</p><h2>{some_text(500 + k, 9)}</h2></article>") for k in range(20)]
    made = {r["k"]: r["_text"] for r in html_tree.extract(spark.createDataFrame(rows, "k int, url string, html string")).collect()}
    assert all(made[100 + k] == "the whole text of it" and made[200 + k] == "told\nin cells" for k in range(20))
    assert all(made[300 + k] == some_text(500 + k, 9) for k in range(20))


def test_html_names_on_what_holds_the_article():
    text = lambda page: html_tree._wanted(html_tree.blocks(page), set())
    assert text("<div class='page with-sidebar'>x<article class=share>told</article><div class=related>no</div></div>") == "told"
    assert text("<div id=search><div role=main class=social>told<p class=promo>no</p></div></div>") == "told"
    assert text("<body><main><article>told</article><div id=comments><article class=comment>no</article></div></main>") == "told"
    assert text("<article>told<div class=comments><article class=comment>no</article></div></article>") == "told"
    assert text("<div class=sidebar>no</div><p>told") == "told"


# 9. URLs

def test_urls_against_every_rule(spark):
    pages = [
        (1, "https://Example.ORG/es/9"), (2, "http://a.example.org/en/12?x"), (3, "http://x.com/fr/1"), (4, "http://x.com/de"),
        (5, "http://x.com/de/"), (6, "http://org"), (7, "http://org/"), (8, None), (9, "no scheme"), (10, "http://blog.cheap-pills.net/"),
        (11, "http://notexample.org/es/1"), (12, "http://forg/x"), (None, "http://org/"), (1, "https://Example.ORG/es/9"),
        (13, "ftp://a.net?u=http://b.org/"), (14, "http://a.net#/ads/"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string")
    made = Counter((r["page_id"], r["rule"], r["verdict"]) for r in urls.judge(frame).collect())
    expected = Counter()
    for k, url in pages:
        host, path = "", ""
        if url and "://" in url:
            rest = url.partition("://")[2]
            host = re.split(r"[/?#]", rest, maxsplit=1)[0]
            path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
            host = host.lower()
        fits = [
            (len(r), r, v) for v, r in urls.HOST_RULES
            if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])
        ]
        own = [v for v, _, p in urls.PATTERN_RULES if re.search(p, (url or "").lower())]
        best = max(fits, default=None)
        expected[k, best[1] if best else None, best[2] if best else max(own, default="allow")] += 1
    assert made == expected
    assert urls.judge(empty(frame)).count() == 0


def test_urls_with_longer_tokens(spark):
    samples = [
        "http://a.doubleclick.net", "http://a.com/ads/", "http://a.com/adserver/", "http://a.com/banner.gif", "http://cheap-pills.com",
        "http://casino.com", "http://viagra.com", "http://porn.com", "http://xxx.com", "http://a.com/free-download",
        "http://a.com/login.php", "http://a.com/cart/checkout", "http://a.com/track/pixel", "http://a.com/wp-admin/", "http://a.com/cgi-bin/",
    ]
    assert all(re.search(p, u) for u, (_, _, p) in zip(samples, urls.PATTERN_RULES, strict=True))
    inner = ["http://a.com/banner1.gif", "http://a.com/banners/top.gif", "http://a.com/free-downloads", "http://a.com/xfree-download"]
    # Listed words must be the commoner ones too, whatever the rarer ones are.
    usual = [f"http://a.com/{w}/{k}" for k in range(9) for w in ("free", "login", "cart", "track", "gif")]
    every = [u + end for u in samples for end in ("", "s", "5", "/9")] + inner + usual
    pages = spark.createDataFrame(list(enumerate(every)), "page_id long, url string")
    made = {r["page_id"]: r["verdict"] for r in urls.judge(pages).collect()}
    expected = {k: "block" if any(re.search(p, u) for _, _, p in urls.PATTERN_RULES) else "allow" for k, u in enumerate(every)}
    assert made == expected


# 10. Lines

def plain_distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def changed(text, pick, alphabet, most):
    made = list(text)
    for _ in range(pick.randint(0, most)):
        at, kind = pick.randrange(len(made)), pick.random()
        if kind < 0.3:
            made.insert(at, pick.choice(alphabet))
        elif kind < 0.6 and len(made) > 1:
            del made[at]
        else:
            made[at] = pick.choice(alphabet)
    return "".join(made)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    pick = random.Random(edits)
    pairs = []
    for _ in range(300):
        a = "".join(pick.choice("abé😀") for _ in range(pick.randint(4, 12)))
        b = changed(a, pick, "abé😀", edits + 1)
        if abs(len(a) - len(b)) <= edits <= min(len(a), len(b)):
            pairs.append((a, b))
    rows = spark.createDataFrame(pairs, "a string, b string").withColumn("d", lines.banded_distance(F.col("a"), F.col("b"), edits))
    for r in rows.collect():
        assert r["d"] == min(edits + 1, plain_distance(r["a"], r["b"]))


def test_links_and_removals_against_all_pairs(spark):
    pick = random.Random(3)
    made = []
    for _ in range(100):
        line = "".join(pick.choice("abcdefgh é") for _ in range(pick.randint(22, 40)))
        made += [line, changed(line, pick, "xyz", 3), changed(line, pick, "xyz", 3)]
    pick.shuffle(made)
    docs = [(k, "\n".join(made[k * 5 : k * 5 + 5])) for k in range(60)] + [(90, None), (91, ""), (92, "short\nshort"), (None, made[0])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    seen, expected = [], {}
    for k, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        if text is None:
            expected[k] = None
            continue
        left = []
        for line in text.split("\n"):
            if len(line) < lines.MIN_CHARS:
                left.append(line)
                continue
            if not any(abs(len(line) - len(o)) <= 2 and plain_distance(line, o) <= 2 for o in seen):
                left.append(line)
            seen.append(line)
        expected[k] = "\n".join(left)
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(frame).collect()}
    assert got == expected


def test_a_group_of_near_lines_is_counted_without_its_pairs(spark):
    made = [f"one line of a large group of near copies, with {chr(97 + k // 26)}{chr(97 + k % 26)} in it" for k in range(100)]
    docs = spark.createDataFrame([(k, f"{line}\nalone {k * 7919:b}") for k, line in enumerate(made)], "doc_id long, text string")
    _, linked = lines.line_links(docs)
    near = [r for r in linked.collect() if r["others"] >= 99]
    # One row for each line, in a group of more than one block, and not one for each pair.
    assert len(near) == 100 > 3 * lines.BLOCK and linked.count() <= 200
    assert sum(not r["late"] for r in near) == 1


def test_lines_odd_rows(spark, odd_docs):
    made = lines.dedup_lines(odd_docs)
    assert made.columns[: len(odd_docs.columns)] == odd_docs.columns and made.count() == 8
    assert lines.dedup_lines(empty(odd_docs)).count() == 0
    with pytest.raises(ValueError):
        lines.line_links(odd_docs, 3, 2)


def test_short_lines_are_linked_and_stay(spark):
    pick = random.Random(8)
    made = ["".join(pick.choice("abc é") for _ in range(pick.randint(1, 9))) for _ in range(60)]
    long = "a line of 24 characters."
    made += ["x", "x", "ab", "ab", "   ", "   ", "", "\t", long, long[:-1], long[:-2] + "!"]
    pick.shuffle(made)
    docs = [(k, "\n".join(made[k * 4 : k * 4 + 4])) for k in range(len(made) // 4 + 1)]
    got = {r["doc_id"]: r for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    every = [(k, line) for k, text in docs for line in text.split("\n") if line.strip()]

    def near(a, b):
        return a == b or (min(len(a), len(b)) > 2 and abs(len(a) - len(b)) <= 2 and plain_distance(a, b) <= 2)

    for k, text in docs:
        mine = [(n, line) for n, (d, line) in enumerate(every) if d == k]
        links = [sum(near(line, other) for m, (_, other) in enumerate(every) if m != n) for n, line in mine]
        assert (got[k]["_n_lines"], got[k]["_n_links"]) == (len(mine), sum(links))
        assert bool(got[k]["_line_classes"]) == any(links)
        # The one line of 24 characters has only shorter ones near it.
        assert got[k]["_n_removed"] == 0 and got[k]["text"] == text
