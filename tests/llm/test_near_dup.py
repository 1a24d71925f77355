"""Near duplicates against all pairs."""

import random

import numpy as np
import pytest

from scenlens.llm import near_dup
from tests.llm.fixtures import clean_text, no_documents, odd_documents


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 2]) for i in range(len(w) - 1)} or ({tuple(w)} if w else set())


def brute(rows):
    """doc_id to (n_shingles, component); doc_ids are unique."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_equals_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for group in range(12):
        words = clean_text(rng, rng.randrange(5, 150)).split()
        for _ in range(rng.randrange(1, 12)):
            changed = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 8)):
                changed[rng.randrange(len(changed))] = f"n{rng.randrange(1000)}"
            rows.append((len(rows) * 3, " ".join(changed)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.label(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_chain_of_links(spark):
    """Each text is like the next, the first and the last are not."""
    words = [f"v{i}" for i in range(100)]
    rows = [(i, " ".join([*words[5 * i :], *(f"z{j}" for j in range(5 * i))])) for i in range(8)]
    want = brute(rows)
    assert len({c for _, c in want.values()}) == 1 and len(shingles(rows[0][1]) & shingles(rows[7][1])) < 70
    got = near_dup.label(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_odd_rows(spark):
    df = odd_documents(spark)
    got = near_dup.label(df).collect()
    assert len(got) == df.count()
    by_id = {r.doc_id: r for r in got if r.doc_id not in (None, 12)}
    want = brute([(r.doc_id, r.text) for r in df.collect() if r.doc_id not in (None,) and not (r.doc_id == 12 and r.lang == "x")])
    assert {i: (r.n_shingles, r.component_id) for i, r in by_id.items()} == {i: v for i, v in want.items() if i != 12}
    want_12 = brute([(r.doc_id, r.text) for r in df.filter("doc_id is not null and (doc_id <> 12 or coalesce(lang, '') <> 'x')").collect()])[12][1]
    blank = by_id[4], by_id[5], by_id[6]
    assert all((r.n_shingles, r.component_id, r.kept) == (0, r.doc_id, True) for r in blank)
    (null,) = [r for r in got if r.doc_id is None]
    assert null.component_id is None and null.kept
    assert {r.component_id for r in got if r.doc_id == 12} == {0, want_12}


def test_no_rows(spark):
    assert near_dup.label(no_documents(spark)).collect() == []
    assert near_dup.deduplicate(no_documents(spark)).columns == no_documents(spark).columns


def test_one_of_each_group_stays(spark):
    df = odd_documents(spark).filter("doc_id is not null and n_chars is null").dropDuplicates(["doc_id"])
    kept = {r.doc_id for r in near_dup.deduplicate(df).collect()}
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert kept == {c for _, c in want.values()}


@pytest.mark.parametrize("n", [1, 2, 7, 60, 900, 5000])
def test_sketch_estimates_similarity(n):
    """Every coordinate is filled, and as many agree as the similarity says."""
    rng = np.random.default_rng(n)
    share = rng.integers(0, 2**63, 4 * n).astype(np.uint64)
    a, b = share[: 3 * n], share[n:]  # similarity 1/2
    x, y = near_dup.sketch(np.unique(a)), near_dup.sketch(np.unique(b))
    assert not (x == near_dup._FREE).any() and abs((x == y).mean() - 0.5) < 0.15
    assert (near_dup.sketch(np.unique(a)) == x).all()


def test_bitmaps_exclude_no_similar_pair(spark):
    rng = np.random.default_rng(5)
    rows = []
    for n in (3, 40, 400, 4000):
        base = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
        for share in (0.0, 0.05, 0.1, 0.2, 0.5):
            other = base.copy()
            other[: int(n * share)] = rng.integers(0, 2**63, int(n * share)).astype(np.uint64)
            a, b = np.unique(base), np.unique(other)
            both = len(np.intersect1d(a, b))
            rows.append((n, share, near_dup.bitmap(a).tolist(), near_dup.bitmap(b).tolist(), len(a), len(b), both / (len(a) + len(b) - both)))
    df = spark.createDataFrame(rows, "n int, share double, x array<long>, y array<long>, m long, k long, j double")
    from pyspark.sql import functions as F

    got = df.withColumn("may", near_dup.may_overlap(*[F.col(c) for c in "xymk"])).collect()
    assert all(r.may for r in got if r.j >= 0.8) and not any(r.may for r in got if r.j < 0.5 and r.n < 1000)


@pytest.mark.parametrize("batch", [7, 10000])
def test_members_of_leads_meet_in_tiles(spark, batch):
    """A hot lead among small ones: the pairs are those that SQL finds one by one, and no tile holds the lead."""
    from pyspark.sql import functions as F

    from scenlens.llm.common import settings

    rng = np.random.default_rng(8)
    rows = []
    for lead, size in [(0, 300), *((k, 2 + k % 5) for k in range(1, 30))]:
        base = rng.integers(0, 2**63, 120).astype(np.uint64) * np.uint64(2)
        for k in range(size):
            other = base.copy()
            changed = int(rng.integers(0, 30))
            other[:changed] = rng.integers(0, 2**63, changed).astype(np.uint64)
            other = np.unique(other[int(rng.integers(0, 30)) :])
            rows.append((lead, 1000 * (k % 7) + 10 * k + lead, len(other), int(rng.integers(0, 40)), near_dup.bitmap(other).tolist()))
    followers = spark.createDataFrame([r[:3] for r in rows], "lead long, id long, n long")
    known = spark.createDataFrame(list({r[1]: (r[1], r[3], r[4]) for r in rows}.values()), "id long, component long, bitmap array<long>")
    groups = near_dup.mixed_groups(followers, known.drop("bitmap"), known.drop("component"), tile=16)
    left, right = (groups.drop("blocks").toDF("lead", *(f"{c}_{s}" for c in ("id", "n", "component", "bits"))) for s in "ab")
    n = F.col("n_a"), F.col("n_b")
    may = near_dup.may_overlap(F.col("bits_a"), F.col("bits_b"), *n) & (F.least(*n) * 100 >= F.greatest(*n) * near_dup.PERCENT)
    want = left.join(right, "lead").filter((F.col("id_a") < F.col("id_b")) & (F.col("component_a") != F.col("component_b")) & may)
    want = {tuple(r) for r in want.select("id_a", "id_b").collect()}
    with settings(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": batch}):
        crossed = near_dup.cross_pairs(groups)
        got = [tuple(r) for r in crossed.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 1000
    assert max(r["count"] for r in near_dup.member_tiles(groups).groupBy("lead", "i", "j").count().collect()) < 100
    assert "Join" not in crossed._jdf.queryExecution().optimizedPlan().toString()


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (101, 102)], "a long, b long")
    got = {r.node: r.component for r in near_dup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_sets_of_the_corpus(spark):
    """Whole sf0.001 documents against all pairs."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.label(df).collect()}
    assert got == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def one_of_each(rows):
    """The rows (doc_id, text, ...) that stay: the least of each component, and all without doc_id or words."""
    known = sorted((r for r in rows if r[0] is not None and shingles(r[1])), key=lambda r: r[:2])
    roots = brute([(i, r[1]) for i, r in enumerate(known)])
    first = [known[i] for i in sorted({c for _, c in roots.values()})]
    return first + [r for r in rows if r[0] is None or not shingles(r[1])]


def test_repeated_rows_leave_one(spark):
    df = odd_documents(spark)
    kept = [(r.doc_id, r.text) for r in near_dup.deduplicate(df).collect()]
    want = one_of_each([(r.doc_id, r.text) for r in df.collect()])
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(kept, key=key) == sorted(want, key=key)


def test_two_texts_of_one_doc_id(spark):
    """20 is like the first text of 12 and 10 like the second: these are two groups, and each keeps a row."""
    rng = random.Random(6)
    one, two = clean_text(rng, 60), clean_text(rng, 60)
    rows = [(20, one + " end"), (12, one), (12, two), (10, two + " end"), (10, two + " end"), (12, one.upper()), (30, clean_text(rng, 50))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.label(df).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(10, 10), (10, 10), (12, 10), (12, 12), (12, 12), (20, 12), (30, 30)]
    kept = sorted((r.doc_id, r.text) for r in near_dup.deduplicate(df).collect())
    assert kept == sorted([(10, two + " end"), (12, one.upper()), rows[-1]])
    assert near_dup.deduplicate(df).columns == df.columns
