"""Spaced seeds against all alignments."""

import random

import numpy as np

from scenlens.llm import decontamination as d
from tests.llm.fixtures import SCHEMA, clean_text, no_documents, odd_documents

ITEMS = "item_id long, text string, doc_id long"


def brute(docs, items):
    """(doc_id, item_id) pairs with an overlap on any diagonal."""
    found = set()
    for i, t in docs:
        doc = d.tokens(t)
        for j, x in items:
            item = d.tokens(x)
            for diagonal in range(-len(item) + 1, len(doc)):
                if d.overlap(doc, item, diagonal):
                    found.add((i, j))
    return found


def test_planted_passages(spark):
    rng = random.Random(4)
    items = [(j, clean_text(rng, rng.choice([8, 15, 30, 60]), 3000)) for j in range(12)]
    docs = []
    for i in range(60):
        words = clean_text(rng, rng.randrange(1, 150), 3000).split()
        if i % 2:
            passage = rng.choice(items)[1].split()
            for _ in range(len(passage) // 15):
                passage[rng.randrange(len(passage))] = "swapped"
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + "," for w in passage] if i % 3 else passage
        docs.append((i, " ".join(words)))
    got = d.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    pairs = {(r.doc_id, r.item_id) for r in got.collect()}
    want = brute(docs, items)
    assert pairs == want and len({i for i, _ in want}) >= 25 and all(i % 2 for i, _ in want)


def test_passage_of_the_last_words_and_parts(spark):
    rng = random.Random(1)
    item = clean_text(rng, 40, 3000)
    w = item.split()
    docs = [(0, item), (1, " ".join(w[5:25])), (2, " ".join(w[:9])), (3, "a " * 50 + " ".join(w[20:])), (4, " ".join(reversed(w)))]
    got = d.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    by = {r.doc_id: (r.first_word, r.n_words, r.n_matched) for r in got.collect()}
    assert by == {0: (0, 40, 40), 1: (0, 20, 20), 3: (50, 20, 20)}


def test_odd_rows(spark):
    df = odd_documents(spark)
    text = df.filter("doc_id = 0").first().text
    items = spark.createDataFrame([(1, text, 3), (1, text, 3), (None, text, 1), (2, None, 1), (3, "", 1), (4, "not there", 1)], ITEMS)
    got = {(r.doc_id, r.item_id) for r in d.overlaps(df, items).collect()}
    like = {r.doc_id for r in df.collect() if r.text and len(d.tokens(r.text)) == 120 and d.overlap(d.tokens(r.text), d.tokens(text), 0)}
    assert {None, 0, 1, 2, 3, 12} <= like
    assert got == {(i, j) for i in like for j in (1, None)}
    kept = d.decontaminated(df, items)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in df.collect() if not alike(r.text, text))
    assert None not in {r.doc_id for r in kept.collect()} and [r.lang for r in kept.filter("doc_id = 12").collect()] == [None]


def alike(text, item):
    words = d.tokens(text)
    return len(words) == 120 and bool(d.overlap(words, d.tokens(item), 0))


def test_short_items(spark):
    """Items of 1 to 12 words in documents that hold them whole, in part, and with a word changed, against all alignments."""
    rng = random.Random(12)
    items = [(j, clean_text(rng, j, 5000)) for j in range(1, 13)]
    docs = []
    for j, text in items:
        w = text.split()
        changed = [[*w[:i], "other", *w[i + 1 :]] for i in range(len(w))] if j < 10 else []
        for words in [w, w[1:], w[:-1], w[2:], w[:4], *changed]:
            around = clean_text(rng, 6, 5000).split()
            docs.append((len(docs), " ".join([*around[:3], *words, *around[3:]])))
            docs.append((len(docs), " ".join(words)))
    got = d.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    pairs, want = {(r.doc_id, r.item_id) for r in got.collect()}, brute(docs, items)
    assert {p for p in pairs if p[1] < 10} == {p for p in want if p[1] < 10} and pairs <= want
    assert {i for _, i in pairs} == set(range(1, 13))
    assert {docs[i][1] for i, j in want - pairs}.isdisjoint(t for _, t in items)


def test_masks_of_short_items_miss_nothing():
    for n in range(1, 10):
        masks = [[k for k, c in enumerate(m) if c == "1"] for m in d.short_masks(n)]
        for pattern in range(1 << n):
            same = np.array([bool(pattern >> i & 1) for i in range(n)])
            found = d.overlap(np.where(same, np.arange(n), -1), np.arange(n), 0)
            seeded = any(all(a + k < n and same[a + k] for k in m) for m in masks for a in range(n - m[-1]))
            assert seeded or not found, (n, same)


def test_no_rows(spark):
    df, none = odd_documents(spark), spark.createDataFrame([], ITEMS)
    assert d.overlaps(df, none).collect() == [] and d.decontaminated(df, none).count() == df.count()
    assert d.overlaps(no_documents(spark), spark.createDataFrame([(1, "a b c d e f g h", 1)], ITEMS)).collect() == []


def test_best_run():
    same = np.array([0, 1, 1, 1, 1, 1, 1, 0, 1, 1, 1, 1, 0, 0, 0, 1], bool)
    assert d.best_run(same) == (1, 12, 10)


def test_passages_of_the_benchmark(spark):
    """Every document of sf0.01 that holds a whole item is found, and none that holds no eight of its words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in d.overlaps(docs, items).collect()}
    words = {r.item_id: [int(x) for x in d.tokens(r.text)] for r in items.collect()}
    eight = {}
    for j, w in words.items():
        for k in range(len(w) - 7):
            eight.setdefault(tuple(w[k : k + 8]), set()).add(j)
    near, whole = set(), set()
    for r in docs.collect():
        w = [int(x) for x in d.tokens(r.text)]
        for k in range(len(w) - 7):
            for j in eight.get(tuple(w[k : k + 8]), ()):
                near.add((r.doc_id, j))
                n = len(words[j])
                if w[k : k + n] == words[j]:
                    whole.add((r.doc_id, j))
    assert whole and whole <= got <= near


def any_run(doc, item, diagonal):
    """The longest run with four of five words equal, and its matches, by trying all; the rule in its own words."""
    same = [doc[k + diagonal] == w if 0 <= k + diagonal < len(doc) else None for k, w in enumerate(item)]
    best = (0, 0)
    for a in range(len(same)):
        n = 0
        for b in range(a, len(same)):
            if same[b] is None:
                break
            n += same[b]
            if same[a] and same[b] and 5 * n >= 4 * (b + 1 - a) > 4 * best[0]:
                best = b + 1 - a, n
    return best if best[0] >= 13 or 5 * best[0] >= 4 * len(item) else None


def loose(rng, words, share):
    return [w if rng.random() < share else "swapped" for w in words]


def test_runs_beside_loose_matches(spark):
    """A verbatim passage counts however the words beside it match."""
    rng = random.Random(8)
    long, mid = (clean_text(rng, n, 9000).split() for n in (200, 120))
    docs = [
        (0, [*long[:40], *(w if i % 7 not in (0, 3) else "swapped" for i, w in enumerate(long[40:]))]),
        (1, [*mid[:20], *(w if i % 4 else "swapped" for i, w in enumerate(mid[20:]))]),
        (2, [w if i % 3 else "swapped" for i, w in enumerate(mid)]),
    ]
    for i in range(3, 40):
        words = loose(rng, mid, 0.7)
        at = rng.randrange(100)
        words[at : at + 14] = mid[at : at + 14]
        docs.append((i, words))
    items = spark.createDataFrame([(0, " ".join(long)), (1, " ".join(mid))], "item_id long, text string")
    got = d.overlaps(spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, int(i > 0)) for i, _ in docs if i != 2}
    words = dict(docs)
    for r in got:
        assert (r.n_words, r.n_matched) == any_run(words[r.doc_id], mid if r.item_id else long, 0)


def test_longest_run_equals_all_runs():
    rng = random.Random(2)
    for _ in range(400):
        item = np.arange(rng.randrange(1, 60))
        share = rng.choice([0.3, 0.6, 0.75, 0.85])
        doc = np.array([w if rng.random() < share else -1 for w in item][: rng.randrange(1, 61)])
        got = d.overlap(doc, item, 0)
        assert (got and got[1:]) == any_run(list(doc), list(item), 0)
