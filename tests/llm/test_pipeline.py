"""The pipeline's stages, each against its input."""

from collections import Counter
from pathlib import Path

import corpus_pipeline
from scenlens.llm import decontamination, mixing, near_dup, quality_rules, token_ids
from scenlens.sources.shared import shared_dir
from tests.llm.fixtures import no_documents, odd_documents
from tests.llm.test_token_ids import ids_of

SF = "/root/testdata/sf0.001"


def staged_folders(spark):
    return [p.name for p in Path(shared_dir(spark), "scenlens").glob("*")]


def similar(a, b):
    return 100 * len(a & b) >= 80 * len(a | b)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    columns, seen = docs.columns, [docs.collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(docs.collect())
        assert name == "token_ids" or docs.columns == columns
    raw, quality, unique, clean, mixed, ids = seen
    by_id = {r.doc_id: r for r in raw}
    for before, after in ((raw, quality), (quality, unique), (unique, clean)):
        assert all(by_id[r.doc_id] == r for r in after)
        assert len({r.doc_id for r in after}) == len(after) < len(before)
    # near duplicates: brute force over all pairs
    sets = {r.doc_id: set(near_dup.shingle_set(r.text, 5).tolist()) for r in quality}
    kept, order = {r.doc_id for r in unique}, sorted(sets)
    links = [(a, b) for x, a in enumerate(order) for b in order[x + 1 :] if similar(sets[a], sets[b])]
    root = {i: i for i in order}
    for _ in order:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert kept == set(root.values()) and links
    # decontamination: nothing that is left holds a whole item, and what went overlaps
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    gone = kept - {r.doc_id for r in clean}
    for r in unique:
        words = decontamination.tokens(r.text).tobytes()
        whole = any(decontamination.tokens(i.text).tobytes() in words for i in items)
        assert not whole or r.doc_id in gone
    # mixing: as often as the mix takes it
    taken = {r.doc_id: int(r.taken / r.size + 0.5) for r in mixing.mix(spark.createDataFrame(clean)).collect()}
    assert Counter(r.doc_id for r in mixed) == +Counter(taken)
    assert max(taken.values()) <= mixing.REPEATS
    assert Counter(r.doc_id for r in ids) == Counter(r.doc_id for r in mixed)
    assert all(r.n_tokens == len(ids_of(by_id[r.doc_id].text)) for r in ids)
    assert sum(r.n_tokens for r in ids) == max(r.start + r.n_tokens for r in ids)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = Counter(map(str, docs.collect()))
        assert all(str(r) in rows for r in out.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_no_rows(spark):
    docs = no_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
        docs = no_documents(spark)


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    assert corpus_pipeline.ORACLE_SQL is None
    before = set(staged_folders(spark))
    out = entry.queries()["pipeline"](spark, SF)
    assert out.count() > 0
    (left,) = set(staged_folders(spark)) - before  # the last stage's output, and nothing else
    assert left in out.inputFiles()[0]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "mixing", "token_ids"]
    assert quality_rules and token_ids
