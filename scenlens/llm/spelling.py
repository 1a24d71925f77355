"""Spelling variants by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point makes the difference: that is so exactly
if their common prefix and their common suffix together reach the longer length less one. Blocks of words
are matrices of code points, padded to one width, left-aligned for prefixes and right-aligned for suffixes;
pairs of blocks are compared column by column, all words against all.

Which blocks meet: of a near pair whose longer word has b code points, the words share their first or their
last ceil((b - 1) / 2) ones. So a word stands in class b, its length, and in class b + 1, each time under its
beginning and its end. Words of one key make a group. Groups of more than ``TILE`` words are dealt to blocks
by hash and every pair of blocks is a tile of its own, so a hot group is spread over tasks; small groups
are packed into one matrix. A pair that shares the beginning counts there and not under its end. A tile
returns for each word the number of its near words and the best one, never the pairs.

Words are distinct results of a damage rule over maximal runs of letters, see ``vocabulary``; each task sums
its own words before they are shuffled.

A word's form is its near word with the largest count (ties: the smallest in code-point order), if that is
at least ``FACTOR`` times the word's own. Forms lead upwards, so chains are short: at most log5 of the
largest count. The root is the end of the chain.

Defined results: a null or empty text has no runs; a null doc_id is written ``null`` before the colon. Rows
with equal ids and texts count each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scenlens.llm.common import partitions, ship
from scenlens.operators.joins import left_join
from scenlens.sources.shared import staged

MIN_LENGTH = 6
MIN_COUNT = 5
DAMAGED = 199  # one run in so many loses a code point
FACTOR = 5
TILE = 4096
PACK = 192  # words of small groups in one matrix
CELLS = 1 << 16  # and its code points
HELD = 200_000  # words that a task sums before it hands them on

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH)


# Words and their counts


def run_counts(text: str) -> Counter:
    """The runs of a text that can give a long enough word, with A-Z lower-cased."""
    found = Counter(_RUN.findall(text))
    out: Counter = Counter()
    for run, n in found.items():
        out[run if run.islower() else run.encode().lower().decode()] += n
    return out


def damaged(head: int, run: str) -> str:
    """The run, or the run without one code point where its hash says so; ``head`` is the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), head)
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def head_of(doc_id: int | None) -> int:
    return zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            head = head_of(doc_id)
            for run, n in run_counts(text.as_py() or "").items():
                word = damaged(head, run)
                if len(word) >= MIN_LENGTH:
                    held[word] += n
            if len(held) > HELD:
                yield out()
                held.clear()
    yield out()


def vocabulary(documents: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words that occur often enough, written."""
    ship(documents.sparkSession)
    counted = documents.select("doc_id", "text").mapInArrow(_count, "word string, n long")
    total = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return staged(total.filter(F.col("n") >= min_count), "vocabulary")


# Tiles


def tiles(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(long, back, key, i, j, word, n): the words of every tile; i and j are the blocks that meet there."""
    size = F.length("word")
    share = F.ceil((F.col("long") - 1) / 2).cast("int")
    classes = words.withColumn("long", F.explode(F.array(size, size + 1)))
    sides = classes.withColumn("back", F.explode(F.array(F.lit(False), F.lit(True))))
    key = F.when(F.col("back"), F.substring("word", F.length("word") - share + 1, share)).otherwise(F.substring("word", F.lit(1), share))
    rows = sides.withColumn("key", key)
    groups = rows.groupBy("long", "back", "key").agg(F.count(F.lit(1)).alias("size"), F.max(F.length("word") == F.col("long")).alias("longer"))
    groups = groups.filter((F.col("size") > 1) & F.col("longer")).select("long", "back", "key", F.ceil(F.col("size") / tile).cast("int").alias("blocks"))
    known = left_join(rows, groups, ["long", "back", "key"], spread=True).filter(F.col("blocks").isNotNull())
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    meeting = known.select("long", "back", "key", block.alias("block"), other.alias("other"), "word", "n")
    return meeting.select("long", "back", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "word", "n")


def matrix(words: list[str], length: int, width: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words of one length, a row each, padded to a width: left-aligned and right-aligned."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)
    space = np.full((len(words), width - length), pad, np.uint32)
    return np.hstack([points, space]), np.hstack([space, points])


def _common(a: np.ndarray, b: np.ndarray, columns: range) -> np.ndarray:
    """For all pairs of rows, how many columns are equal before the first that isn't."""
    alive = np.ones((len(a), len(b)), bool)
    out = np.zeros((len(a), len(b)), np.uint8 if a.shape[1] < 256 else np.uint32)
    for c in columns:
        alive &= a[:, c, None] == b[None, :, c]
        if not alive.any():
            break
        out += alive
    return out


_SLICE = 512  # rows of one block that are compared at once


def near_pairs(a: tuple, b: tuple, long: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of the matrices a and b that differ by one edit, and the length of their common prefix."""
    for lo in range(0, len(a[0]), _SLICE):
        front, end = (m[lo : lo + _SLICE] for m in a)
        prefix = _common(front, b[0], range(long))
        suffix = _common(end, b[1], range(long - 1, -1, -1))
        x, y = np.nonzero(prefix >= long - 1 - np.minimum(suffix, long - 1))
        yield x + lo, y, prefix[x, y]


def compare(long: int, back: bool, words: list[str], groups: np.ndarray, blocks: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the near words, pair by pair, of a tile: whole groups of one class and side, or two blocks of one group."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    share = -(-(long - 1) // 2)
    rows = [np.flatnonzero(lengths == n) for n in (long, long - 1)]
    made = [matrix([words[p] for p in at], n, long, pad) for at, n, pad in zip(rows, (long, long - 1), (1, 2), strict=True)]
    pairs: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for at, other in zip(rows, made, strict=True):
        for x, y, prefix in near_pairs(made[0], other, long):
            a, b = rows[0][x], at[y]
            good = groups[a] == groups[b]
            if back:
                good &= prefix < share  # a shared beginning counts there
            if at is rows[0]:
                good &= a < b
            if i != j:
                good &= blocks[a] != blocks[b]
            pairs.append((a[good], b[good]))
    return tuple(np.concatenate(side) for side in zip(*pairs, strict=True))


def _best(words: list[str], counts: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict[str, list]:
    """For each word of a pair: how many near words, the best one and its count."""
    if not len(a):
        return {"word": [], "n_near": [], "best": [], "best_n": []}
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    one, two = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.lexsort((rank[two], -counts[two], one))
    one, two = one[order], two[order]
    first = np.flatnonzero(np.diff(one, prepend=-1))
    n = np.diff(np.append(first, len(one)))
    return {
        "word": [words[p] for p in one[first]],
        "n_near": n.tolist(),
        "best": [words[p] for p in two[first]],
        "best_n": counts[two[first]].tolist(),
    }


TILED = "word string, n_near long, best string, best_n long"


def _tile_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted tiles to their near words; small groups of one class and side are packed."""
    kinds = {"word": pa.string(), "n_near": pa.int64(), "best": pa.string(), "best_n": pa.int64()}
    words: list[str] = []
    counts: list[int] = []
    groups: list[int] = []
    blocks: list[int] = []
    tile: tuple | None = None
    packed: tuple | None = None
    number = 0

    def flush() -> pa.RecordBatch:
        long, back, i, j = packed
        a, b = compare(long, back, words, np.array(groups), np.array(blocks), i, j)
        found = _best(words, np.array(counts), a, b)
        for x in (words, counts, groups, blocks):
            x.clear()
        return pa.RecordBatch.from_arrays([pa.array(found[c], t) for c, t in kinds.items()], list(kinds))

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("long", "back", "key", "i", "j", "block", "word", "n"))
        for long, back, key, i, j, block, word, n in zip(*columns, strict=True):
            if tile != (long, back, key, i, j):
                if words and (packed != (long, back, i, j) or i != j or len(words) >= PACK or len(words) * long >= CELLS):
                    yield flush()
                tile, packed = (long, back, key, i, j), (long, back, i, j)
                number += 1
            words.append(word)
            counts.append(n)
            groups.append(number)
            blocks.append(block)
    if words:
        yield flush()


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best, best_n) of the words that have near words."""
    spark = words.sparkSession
    ship(spark)
    key = ["long", "back", "key", "i", "j"]
    dealt = tiles(words, tile).repartition(partitions(spark), *key).sortWithinPartitions(*key, "word")
    found = dealt.mapInArrow(_tile_rows, TILED)
    least = F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("least")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least).select(
        "word", "n_near", F.col("least.best").alias("best"), (-F.col("least.minus")).alias("best_n")
    )


def rooted(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): every word that has a form, and the end of its chain.

    In each round a word takes the root that its root has; that doubles the length of known chains.
    """
    roots = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = staged(left_join(roots, ahead, "root"), "roots")
        if further.filter("further is not null").isEmpty():
            return further.select("word", "root")
        roots = further.select("word", F.coalesce("further", "root").alias("root"))


def variants(documents: DataFrame, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of ``documents`` (doc_id, text)."""
    words = vocabulary(documents)
    known = left_join(words, near_words(words, tile), "word")
    enough = F.col("best_n") >= F.col("n") * FACTOR
    formed = staged(
        known.select(
            "word",
            F.when(enough, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = rooted(formed.filter("form is not null"))
    return left_join(formed, roots, "word").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
