"""Neighbour votes: held-out accuracy, exactness of the search, odd rows."""

import zlib

import numpy as np

from scenlens.llm import classifier
from tests.llm.fixtures import no_documents, odd_documents

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = classifier.classify(documents, labels).join(labels, "doc_id").filter("held_out").collect()
    good = np.mean([r.predicted for r in got if r.quality == 1])
    bad = np.mean([1 - r.predicted for r in got if r.quality == 0])
    assert len(got) > 1000 and good > 0.98 and bad > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_labels_of_the_held_out_and_other_columns_do_not_matter(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "cast(if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - quality, quality) as int) quality", "toxic")
    changed = documents.selectExpr("doc_id", "text", "'x' lang", "'y' source", "1 n_chars")
    first = {r.doc_id: r.score for r in classifier.classify(documents, labels).collect()}
    again = {r.doc_id: r.score for r in classifier.classify(changed, flipped).collect()}
    assert first == again


def test_blocks_equal_one_by_one(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = classifier.fit(documents, labels)
    scores = {r.doc_id: r.score for r in classifier.score(documents, model).collect()}
    for r in documents.limit(40).collect():
        v = model.vector(classifier.features(r.text))
        cosine = model.vectors @ v
        near = np.argsort(-cosine, kind="stable")[: classifier.NEIGHBOURS]
        w = np.maximum(cosine[near], 1e-6).astype(float) ** 4
        good, bad = (w * model.good[near]).sum(), (w * model.bad[near]).sum()
        assert abs(scores[r.doc_id] - good / (good + bad)) < 1e-3


def test_odd_rows(spark):
    df = odd_documents(spark)
    labels = [(i, i % 2, None) for i in range(20)] + [(3, 1, 1), (3, 0, 1), (None, 1, 1), (7, None, 1), (999, 0, 0)]
    got = classifier.classify(df, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    blank = {r.score for r in got if r.doc_id in (4, 5, 6)}
    assert len(blank) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [False]


def test_no_labels_and_no_rows(spark):
    df, none = odd_documents(spark), spark.createDataFrame([], LABELS)
    assert {r.score for r in classifier.classify(df, none).collect()} == {0.5}
    assert classifier.classify(no_documents(spark), none).collect() == []
    one = spark.createDataFrame([(0, 1, 0)], LABELS)
    assert all(r.score == 1 for r in classifier.classify(df, one).collect() if r.doc_id in (0, 1))
