"""Quality classifier: labelled neighbours vote, by cosine similarity in a latent-semantic space.

Texts become hashed counts of byte trigrams of the whole text, and of a few statistics of its words in
steps; weighted by TF-IDF they are projected to ``RANK`` dimensions by a truncated SVD. The fit sees a
bounded sample of labelled rows: of each label the ``PER_LABEL`` rows with the least hash of their id, out
of those whose crc32(doc_id) mod 3 is not 1. Their vectors, at most 2 x PER_LABEL x RANK floats (1 MB), go
to every task, which computes the cosine of every document with every one of them, in blocks; the
``NEIGHBOURS`` nearest vote with their similarity, and votes count inversely to their label's share in the
sample, so the two labels start even.

Labels, lang, source and doc_id are never inputs of a score.

Defined results: a null or empty text has no vector; its score is the share of label 1 in the sample,
which also holds for every text where no labels are known. Repeated labels of a document are taken once,
the largest; null labels are left out. A row without doc_id is held in (its remainder is null) and scored.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scenlens.llm.common import ship
from scenlens.llm.words import encoded
from scenlens.sources.shared import staged

DIMENSIONS = 4096
STATISTICS = 256
RANK = 64
PER_LABEL = 2048
NEIGHBOURS = 25
BLOCK = 512
SEED = 11


def _steps(x: float, n: int = 12) -> int:
    return min(n - 1, int(x * n))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Indices and damped counts of a text's features."""
    data = encoded(text)
    words = data.split()
    if not words:
        return None
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(b) >= 3:
        grams = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        hashed = (grams * np.uint32(2654435761)) >> np.uint32(20)
        counts = np.bincount(hashed, minlength=DIMENSIONS)
    else:
        counts = np.bincount([zlib.crc32(data) % DIMENSIONS], minlength=DIMENSIONS)
    index = np.flatnonzero(counts)
    n, lines = len(words), data.split(b"\n")
    pairs = set(zip(words, words[1:], strict=False))
    upper = sum(65 <= c <= 90 for c in data) if len(data) < 64 else int(((b >= 65) & (b <= 90)).sum())
    marks = int((((b >= 33) & (b < 48)) | ((b >= 58) & (b < 65)) | (b == 124)).sum())
    statistics = [
        _steps(len(set(words)) / n),
        _steps(len(pairs) / max(1, n - 1)),
        _steps(len(set(lines)) / len(lines)),
        _steps(min(0.99, 2 * upper / len(b))),
        _steps(min(0.99, 3 * marks / len(b))),
        min(11, int(np.log2(n))),
        min(11, int(len(b) / n / 2)),
    ]
    extra = DIMENSIONS + np.arange(len(statistics)) * 16 + statistics
    weights = 1 + np.log(counts[index])
    boost = np.full(len(extra), np.sqrt((weights**2).sum() / len(extra)))
    return np.concatenate([index, extra]), np.concatenate([weights, boost])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t.as_py()) for t in batch.column("text")]
        empty = np.empty(0)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("quality"),
                pa.array([f[0].astype(np.int32) if f else empty.astype(np.int32) for f in found], pa.list_(pa.int32())),
                pa.array([f[1].astype(np.float32) if f else empty.astype(np.float32) for f in found], pa.list_(pa.float32())),
            ],
            ["quality", "index", "weight"],
        )


@dataclass
class Model:
    """IDF weights, projection, unit vectors of the labelled sample, and each one's vote for label 1 and 0."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    good: np.ndarray
    bad: np.ndarray
    prior: float

    def vector(self, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        index, weight = found
        x = weight * self.idf[index]
        return _unit((x / np.linalg.norm(x)).astype(np.float32) @ self.projection[index])

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        cosine = vectors @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(cosine, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6).astype(np.float64) ** 4
        good = (weight * self.good[near]).sum(axis=1)
        return good / (good + (weight * self.bad[near]).sum(axis=1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """(quality, text): at most ``per_label`` rows of each label, by hash of the id."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    order = [F.xxhash64("doc_id", F.lit(SEED)), F.col("doc_id")]
    ids = [known.filter(F.col("quality") == q).orderBy(*order).limit(per_label) for q in (0, 1)]
    chosen = staged(ids[0].unionByName(ids[1]), "labelled_ids")
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # 2 x per_label rows
    return rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # rows that share an id count once


def fit(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    ship(documents.sparkSession)
    sample = labelled_sample(documents, labels, per_label).orderBy("doc_id").select("quality", "text")
    rows = sample.mapInArrow(_featured, "quality int, index array<int>, weight array<float>").toArrow()
    quality = rows["quality"].to_numpy().astype(np.float64)
    prior = float(quality.mean()) if len(quality) else 0.5
    width = DIMENSIONS + STATISTICS
    x = np.zeros((len(quality), width), np.float32)
    for i, (index, weight) in enumerate(zip(rows["index"], rows["weight"], strict=True)):
        x[i, index.values.to_numpy()] = weight.values.to_numpy()
    full = (x != 0).any(axis=1)
    x, quality = x[full], quality[full]
    idf = (np.log((1 + len(x)) / (1 + np.count_nonzero(x, axis=0))) + 1).astype(np.float32)
    x *= idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    rng = np.random.default_rng(SEED)
    rank = min(RANK, max(1, len(x)))
    basis = rng.standard_normal((width, rank + 16), dtype=np.float32)
    for _ in range(4):  # power iterations towards the leading right singular vectors
        basis = np.linalg.qr(x.T @ (x @ basis))[0] if len(x) else basis
    _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
    projection = np.ascontiguousarray((basis @ right.T)[:, :rank], np.float32)
    good = quality / max(1.0, quality.sum())
    bad = (1 - quality) / max(1.0, (1 - quality).sum())
    return Model(idf, projection, _unit(x @ projection), good, bad, prior)


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            scores = np.full(len(batch), model.prior)
            texts = batch.column("text")
            for lo in range(0, len(batch), BLOCK):
                found = [features(texts[i].as_py()) for i in range(lo, min(lo + BLOCK, len(batch)))]
                rows = [i for i, f in enumerate(found) if f]
                if rows and len(model.vectors):
                    scores[lo + np.array(rows)] = model.scores(np.stack([model.vector(found[i]) for i in rows]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each document."""
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scored(shared), "doc_id long, score double")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    scored = score(documents, fit(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
