"""Spelling variants against pairwise comparison."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from scenlens.llm import spelling
from tests.llm.fixtures import SCHEMA, no_documents, odd_documents


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\u0080" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def expected(words):
    out = {}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=2, max_size=7), unique=True, min_size=1, max_size=40), st.integers(1, 3))
def test_tiles_find_all_pairs_once(words, blocks):
    """Every class and side of a small vocabulary, with groups cut into blocks."""
    pairs = Counter()
    for long in range(2, 9):
        share = -(-(long - 1) // 2)
        for back in (False, True):
            members = [w for w in words if len(w) in (long, long - 1)]
            keys = {w: (w[len(w) - share :] if back else w[:share]) for w in members}
            number = {k: i for i, k in enumerate(dict.fromkeys(keys.values()))}
            for i in range(blocks):
                for j in range(i, blocks):
                    some = [w for w in members if zlib.crc32(w.encode()) % blocks in (i, j)]
                    if some:
                        groups = np.array([number[keys[w]] for w in some])
                        dealt = np.array([zlib.crc32(w.encode()) % blocks for w in some])
                        for a, b in zip(*spelling.compare(long, back, some, groups, dealt, i, j), strict=True):
                            pairs[frozenset((some[a], some[b]))] += 1
    assert pairs == Counter(frozenset((a, b)) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b))


def test_variants_of_odd_rows(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 9))) for _ in range(60)]
    base += [b[:3] + rng.choice("abcdeé") + b[4:] for b in base] + [b + "s" for b in base[:30]] + [b[1:] for b in base[:30]]
    base += ["colour", "color", "colours", "COLOURS", "ÉCOLES", "écoles", "naïves", "na×ves"]
    rows = [(i, " ".join(rng.choice(base) for _ in range(rng.randrange(200)))) for i in range(60)]
    rows += [(900, "colours " * 200), (901, "colour-colour, colour1colour\n" * 2), (902, "colouur " * 6), (None, "coloours " * 40), (None, None), rows[3]]
    rows += [(903, "z" * 70_000 + " "), (904, ("y" * 3000 + " ") * 5), (905, ("y" * 2999 + " ") * 30)]
    df = spark.createDataFrame([(*r, None, None, 1, 1, 1, 1) for r in rows], SCHEMA).unionByName(odd_documents(spark))
    want = expected(words_of([(r.doc_id, r.text) for r in df.collect()]))
    assert got(spelling.variants(df)) == want
    assert got(spelling.variants(df, tile=3)) == want
    assert any(r[0] and r[1] != r[0] for r in want.values()) and max(r[3] for r in want.values()) >= 3


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(spelling.variants(df)) == expected(words_of([(r.doc_id, r.text) for r in df.collect()]))


def test_no_rows(spark):
    assert spelling.variants(no_documents(spark)).collect() == []
