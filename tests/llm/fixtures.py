"""Small documents with what operators must bear, and helpers for brute-force results."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, position long"


def clean_text(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def odd_documents(spark, n: int = 40):
    """Copies, near copies, null, empty, blank and long texts, repeated rows, null ids, clashing columns."""
    rng = random.Random(7)
    base = clean_text(rng, 120)
    words = base.split()
    near = " ".join(["other", *words[1:]])
    texts = [base, base, near, base.upper(), "", None, " \t\n", "one", "One ", clean_text(rng, 6000)]
    texts += [f"a b c  dé {i % 3}" for i in range(6)]
    texts += [clean_text(rng, rng.randrange(1, 200)) for _ in range(n - len(texts))]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, None, 7, 1, 3) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, base, None, None, None, None, None, None), (12, base, "x", "s1", 1, 1, 1, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
