"""Benchmark decontamination by spaced seeds.

A mask picks some positions of a window of words; a window's hash covers these only, so a substitution at
an ignored position does no harm, and of a few masks one usually passes between substitutions. An item
shorter than the longest mask has masks of its own, for every run of its words that would be an overlap and
every place in it where a word may differ, so none of its overlaps is missed. The hashes
of all windows of all documents are compared with those of the benchmark: first with a bitmap of
2^``BITMAP_BITS`` bits, which every task holds and whose size does not depend on the benchmark, then, for
what passes, by a join on the hash. A hit gives a document, an item and a diagonal (document position -
item position).

On each diagonal document and item are compared word by word, as far as the item reaches. Any run of
positions that starts and ends with a match is an overlap if ``IDENTITY`` of its words match and it has
``MIN_WORDS`` words, or ``IDENTITY`` of the item where that is shorter. The longest one is reported.

A document is not carried through the join: a task cuts out the region around its hits, as far as the
longest item reaches, as word hashes.

Words: lower-cased, with ASCII punctuation and white space as breaks.

Defined results: a null or empty text, or item, overlaps with nothing; an item of few words is searched like
any other. Rows with a null doc_id or item_id take part, and rows with equal ids and regions are one. Documents
are removed by their text, so rows with one doc_id are judged each by its own and rows without one too.
An empty table on either side gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scenlens.llm.common import ship
from scenlens.llm.vocabularies import release
from scenlens.llm.words import encoded, window_hashes, word_hashes
from scenlens.operators.joins import inner_join
from scenlens.sources.shared import staged

MASKS = ("1110111", "11011011", "1101010011")
BITMAP_BITS = 24
MIN_WORDS = 13
IDENTITY = 0.8
BROADCAST_IDS = 2_000_000  # 32 MB of digests

_BREAKS = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_PERCENT = round(100 * IDENTITY)
_SPAN = max(len(m) for m in MASKS)


def tokens(text: str | None) -> np.ndarray:
    return word_hashes(encoded((text or "").lower()).translate(_BREAKS).split())


def short_masks(n: int) -> list[str]:
    """Masks for an item of ``n`` words: of each run that is long enough, each place where one word may differ."""
    out = []
    for run in range(-(-_PERCENT * n // 100), n + 1):
        if run - -(-_PERCENT * run // 100):
            out += ["1" * i + "0" + "1" * (run - 1 - i) for i in range(1, run - 1)]
        else:
            out.append("1" * run)
    return out


def masks_for(lengths: Iterable[int]) -> list[str]:
    """All masks that documents are searched by, given the lengths of the items."""
    return [*MASKS, *sorted({m for n in lengths if 0 < n < _SPAN for m in short_masks(n)} - set(MASKS))]


def seeds(words: np.ndarray, masks: Iterable[str]) -> list[np.ndarray]:
    """For each mask the hashes of all windows; masks differ in their hashes."""
    return [window_hashes(words, [i for i, c in enumerate(m) if c == "1"]) ^ np.uint64(int("1" + m, 2)) for m in masks]


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [tokens(t.as_py()) for t in batch.column("text")]
        found = [[(i, at, int(h)) for s in seeds(w, masks_for([len(w)])) for at, h in enumerate(s.view(np.int64))] for i, w in enumerate(words)]
        columns = [batch.column("item_id"), [w.view(np.int64) for w in words], [[x[1] for x in f] for f in found], [[x[2] for x in f] for f in found]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) if not isinstance(c, pa.Array) else c.cast(t) for c, t in zip(columns, kinds, strict=True)],
            ["item_id", "item_words", "ats", "seeds"],
        )


def regions(words: np.ndarray, bitmap: np.ndarray, reach: int, masks: list[str]) -> Iterator[tuple[int, np.ndarray, list, list]]:
    """(start, words, hit positions, hit hashes) of the parts of a text around windows that the bitmap knows."""
    ats, keys = [], []
    for s in seeds(words, masks):
        slots = _slots(s)
        hit = np.flatnonzero((bitmap[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1)
        ats.append(hit)
        keys.append(s[hit])
    at, key = np.concatenate(ats), np.concatenate(keys)
    if not len(at):
        return
    order = np.argsort(at, kind="stable")
    at, key = at[order], key[order].view(np.int64)
    breaks = np.flatnonzero(np.diff(at) > 2 * reach + _SPAN) + 1
    for a, k in zip(np.split(at, breaks), np.split(key, breaks), strict=True):
        start = max(0, int(a[0]) - reach)
        yield start, words[start : int(a[-1]) + _SPAN + reach].view(np.int64), a - start, k


def _hits(bitmap, reach: int, masks: list[str], kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        bits = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            rows = [
                (i, *region)
                for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)
                for region in regions(tokens(text.as_py()), bits, reach, masks)
            ]
            kinds = [kind, pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "start", "words", "ats", "keys"]
            )

    return run


def best_run(same: np.ndarray) -> tuple[int, int, int]:
    """(start, end, matches) of the longest run with IDENTITY matches that starts and ends with one; the first of equals."""
    starts = np.flatnonzero(same)
    if not len(starts):
        return 0, 0, 0
    total = np.concatenate([[0], np.cumsum(np.where(same, 100 - _PERCENT, -_PERCENT))])
    ends = starts + 1
    most = np.maximum.accumulate(total[ends][::-1])[::-1]  # of this end and all later ones
    last = ends[np.searchsorted(-most, -total[starts], side="right") - 1]
    i = int(np.argmax(last - starts))
    start, end = int(starts[i]), int(last[i])
    return start, end, int(same[start:end].sum())


def overlap(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """(start in the document's words, words, matches) of the overlap on a diagonal, if there is one."""
    lo, hi = max(0, diagonal), min(len(doc), diagonal + len(item))
    if hi <= lo:
        return None
    start, end, matches = best_run(doc[lo:hi] == item[lo - diagonal : hi - diagonal])
    n = end - start
    return (lo + start, n, matches) if n >= MIN_WORDS or n * 100 >= _PERCENT * len(item) else None


def _verify(words: pd.Series, item: pd.Series, diagonal: pd.Series) -> pd.DataFrame:
    found = [overlap(w, i, d) or (None, None, None) for w, i, d in zip(words, item, diagonal, strict=True)]
    return pd.DataFrame(found, columns=["at", "n_words", "n_matched"], dtype="Int64")


def bitmap_of(keys: DataFrame) -> bytes:
    """Which slots the ``seed`` column fills: at most 2^BITMAP_BITS / 32 rows come to the driver."""
    slot = F.shiftrightunsigned("seed", 64 - BITMAP_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(31).cast("int"))
    cells = keys.groupBy(F.shiftright(slot, 5).alias("cell")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    for cell, bits in cells.collect():
        out[cell] = bits
    return out.astype("<u4").tobytes()


def overlaps(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, first word, number of words and matches of each overlap: the best per document and item."""
    return _overlaps(documents.select(F.col("doc_id").cast("long"), "text"), benchmark)


def _overlaps(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The same for documents with a key of any type as their doc_id."""
    from pyspark.sql.pandas.types import to_arrow_type

    key = documents.schema["doc_id"].dataType
    spark = documents.sparkSession
    ship(spark)
    items = staged(
        benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(
            _items, "item_id long, item_words array<long>, ats array<int>, seeds array<long>"
        ),
        "benchmark_items",
    )
    keys = items.select("item_id", "item_words", F.inline(F.arrays_zip("ats", F.col("seeds").alias("seed")))).toDF("item_id", "item_words", "at", "seed")
    keys = staged(keys, "benchmark_seeds")
    reach = items.agg(F.max(F.size("item_words"))).first()[0] or 0
    short = items.select(F.size("item_words").alias("n")).filter(F.col("n") < _SPAN).distinct().collect()  # a few numbers
    masks = masks_for(r.n for r in short)
    bitmap = spark.sparkContext.broadcast(bitmap_of(keys))
    rows = documents.mapInArrow(
        _hits(bitmap, reach, masks, to_arrow_type(key)),
        f"doc_id {key.simpleString()}, start long, words array<long>, ats array<int>, keys array<long>",
    )
    parts = staged(rows.withColumn("region", F.xxhash64("doc_id", "start", "words")), "regions")
    hits = parts.select("region", F.inline(F.arrays_zip("ats", "keys"))).toDF("region", "pos", "seed")
    diagonals = hits.join(keys.select("item_id", "at", "seed"), "seed").select("region", "item_id", (F.col("pos") - F.col("at")).alias("diagonal"))
    diagonals = staged(diagonals.distinct(), "diagonals")
    verify = F.pandas_udf(_verify, "at long, n_words long, n_matched long")
    texts = parts.select("region", "doc_id", "start", "words").dropDuplicates(["region"])
    joined = inner_join(diagonals.join(texts, "region"), items.select("item_id", "item_words"), "item_id", null_keys=True)
    found = joined.withColumn("found", verify("words", "item_words", "diagonal")).filter(F.col("found.at").isNotNull())
    rows = found.select("doc_id", "item_id", F.col("found.n_matched"), F.col("found.n_words"), (F.col("start") + F.col("found.at")).alias("first_word"))
    best = F.max(F.struct("n_matched", -F.col("n_words"), -F.col("first_word"))).alias("best")
    return rows.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id",
        "item_id",
        (-F.col("best.col3")).alias("first_word"),
        (-F.col("best.col2")).alias("n_words"),
        F.col("best.n_matched").alias("n_matched"),
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without overlaps, with all their columns. Equal texts go together, whatever their doc_ids are."""
    digest = F.unhex(F.md5(F.col("text").cast("binary")))
    found = _overlaps(documents.select(digest.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__digest"))
    found = staged(found.distinct(), "contaminated")
    gone = F.broadcast(found) if found.count() <= BROADCAST_IDS else found
    rows = documents.withColumn("__digest", digest).join(gone, "__digest", "left_anti")
    return rows.select(*[F.col(f"`{c}`") for c in documents.columns])
