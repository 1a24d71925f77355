"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components.

A document's set holds its distinct two-word shingles; shingles are 64-bit hashes. Documents with equal
sets form a class, which is handled once. Its sketch has ``T`` coordinates and is filled in rounds: round i
throws every shingle into one random bin, with i and a random fraction as its value, and each bin keeps its
least value. After round T the bins still empty are filled one by one, bin b from all shingles in round
T + b. So every coordinate is filled, costs O(T log T + n) for a set of n, and two sketches agree in a
coordinate with probability close to the sets' similarity, with the bounds of independent coordinates.

``BANDS`` bands of ``ROWS`` coordinates each make buckets. Two sets of similarity 0.8 share no bucket with
probability (1 - 0.8^6)^48 < 5e-7. Within a bucket each member is compared on the full sets with the
smallest one, its lead; the links found join classes to components. Members with one lead that are still in
different components are then compared too, unless a link is impossible by their sizes or by bitmaps of
``BITS`` slots: slots that only one set fills are elements that the other lacks. The bitmaps of a lead's members
meet in tiles of two blocks, each about ``TILE`` members that a hash deals out, so a hot lead is spread over
tasks. So a bucket of thousands of copies costs a comparison each, pairs that cannot link cost no row, no
candidate is left out, and the components are those of all links between candidates.

Defined results: a text without words, or null, has an empty set, links with nothing and stays. A row
without doc_id links with nothing, has a null component and stays. Rows with the same text are one class;
rows that share a doc_id are judged each by its own text: classes go by their set's signature, and a
component is named by its least doc_id. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from scenlens.llm.common import partitions, ship
from scenlens.llm.vocabularies import release
from scenlens.llm.words import encoded, mix, window_hashes, word_hashes
from scenlens.operators.joins import anti_join, inner_join, left_join
from scenlens.sources.shared import staged

BANDS, ROWS = 48, 6
T = BANDS * ROWS
SHINGLE = 2
PERCENT = 80
BROADCAST_IDS = 2_000_000  # 16 MB of ids
ROW = "__row"
BITS = 4096  # of the bitmap that bounds two sets' overlap
TILE = 256  # members of one lead in a block

_SEEDS = mix(np.arange(2 * T, dtype=np.uint64) + np.uint64(0xFA57))
_BAND_SEEDS = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(0xBA2D))
_FREE = np.uint64(2**64 - 1)
_LOW = np.uint64(0xFFFFFFFF)
_SHIFT = np.uint64(32)
_ELEMENTS = 1 << 18  # that one step of a sketch handles
_MEET = 1 << 12  # pairs whose bitmaps are compared at once
_FOUND = 1 << 16  # pairs that a task gathers before it hands them on


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles; the whole sequence is one where there are fewer words."""
    words = encoded(text).lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), list(range(min(size, len(words))))))


def sketch(elements: np.ndarray) -> np.ndarray:
    """The T coordinates of a set that is not empty."""
    best = np.full(T, _FREE)
    n, i = len(elements), 0
    step = max(1, min(T, _ELEMENTS // n, int(T * (np.log(T) + 1) / n)))
    while i < T:
        rounds = min(step, T - i)
        x = mix(elements[None, :] ^ _SEEDS[i : i + rounds, None])
        bins = ((x >> _SHIFT) * np.uint64(T)) >> _SHIFT
        values = (np.arange(i, i + rounds, dtype=np.uint64) << _SHIFT)[:, None] | (x & _LOW)
        np.minimum.at(best, bins.ravel().astype(np.int64), values.ravel())
        i += rounds
        if (best != _FREE).all():
            return best
    for b in np.flatnonzero(best == _FREE):
        best[b] = (np.uint64(T + b) << _SHIFT) | (mix(elements ^ _SEEDS[T + b]) & _LOW).min()
    return best


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    rows = coordinates.reshape(BANDS, ROWS)
    out = _BAND_SEEDS
    for j in range(ROWS):
        out = mix(out ^ rows[:, j])
    return out.view(np.int64)


def bitmap(elements: np.ndarray) -> np.ndarray:
    """Which of BITS slots a set's elements fall into, in longs."""
    bits = np.zeros(BITS, np.uint8)
    bits[(elements >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def signature(elements: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None


def _sketches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            sizes, signatures, bands, bitmaps = [], [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), shingle)
                sizes.append(len(s))
                signatures.append(signature(s))
                bands.append(band_keys(sketch(s)) if len(s) else None)
                bitmaps.append(bitmap(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(ROW),
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(bitmaps, pa.list_(pa.int64())),
                ],
                [ROW, "doc_id", "n_shingles", "signature", "bands", "bitmap"],
            )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(signature, sets), pa.binary()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))],
                ["signature", "shingles"],
            )

    return run


def sketched(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """ROW, doc_id, n_shingles, signature of the set and band keys, written once."""
    ship(documents.sparkSession)
    schema = f"{ROW} long, doc_id long, n_shingles long, signature binary, bands array<long>, bitmap array<long>"
    return staged(documents.select(ROW, "doc_id", "text").mapInArrow(_sketches(shingle), schema), "sketches")


def named_classes(sketches: DataFrame) -> DataFrame:
    """(signature, doc_id, id) of each class: its least doc_id, and a number of its own, as classes can share a doc_id."""
    known = sketches.filter(F.col("signature").isNotNull() & F.col("doc_id").isNotNull())
    least = known.groupBy("signature").agg(F.min("doc_id").alias("doc_id"))
    return staged(least.withColumn("id", F.monotonically_increasing_id()), "classes")


def representatives(sketches: DataFrame, names: DataFrame) -> DataFrame:
    """(id, n, bands, bitmap) of each class, from the rows with its least doc_id."""
    known = sketches.filter(F.col("bands").isNotNull() & F.col("doc_id").isNotNull())
    one = left_join(known, names.withColumnRenamed("doc_id", "least"), "signature", spread=True).filter(F.col("doc_id") == F.col("least"))
    return one.select("id", F.col("n_shingles").alias("n"), "bands", "bitmap")


def bucket_members(classes: DataFrame) -> DataFrame:
    """(key, id, n) of the classes in each bucket that has more than one."""
    rows = classes.select(F.explode("bands").alias("key"), "id", "n")
    shared = rows.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last"))
    shared = shared.filter(F.col("lead") < F.col("last")).select("key", F.hash("key").alias("spread"))
    rows = rows.withColumn("spread", F.hash("key"))
    return staged(rows.join(shared, ["key", "spread"], "left_semi").drop("spread").distinct(), "buckets")


def _alike(n, m):
    """Sets of such sizes may be similar enough."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def may_overlap(bits_a, bits_b, n_a, n_b):
    """An exact test that excludes pairs: a slot that only one set fills holds an element that the other lacks.

    In SQL, for single pairs; ``possible_pairs`` is the same test for the rows of a tile.
    """

    def only(x, y):
        counts = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
        return F.aggregate(counts, F.lit(0), lambda acc, c: acc + c)

    both = F.least(n_a - only(bits_a, bits_b), n_b - only(bits_b, bits_a))
    return both * 100 >= (n_a + n_b - both) * PERCENT


def possible_pairs(n: np.ndarray, components: np.ndarray, bits: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of a tile, in different components and blocks (if it has two), that may be similar enough."""
    wanted = np.triu(components[:, None] != components[None, :], 1)
    if blocks.min() != blocks.max():
        wanted &= blocks[:, None] != blocks[None, :]
    wanted &= np.minimum(n[:, None], n[None, :]) * 100 >= np.maximum(n[:, None], n[None, :]) * PERCENT
    x, y = np.nonzero(wanted)
    filled = np.bitwise_count(bits).sum(1, dtype=np.int64)
    good = np.zeros(len(x), bool)
    for lo in range(0, len(x), _MEET):
        a, b = x[lo : lo + _MEET], y[lo : lo + _MEET]
        shared = np.bitwise_count(bits[a] & bits[b]).sum(1, dtype=np.int64)
        both = np.minimum(n[a] - filled[a], n[b] - filled[b]) + shared
        good[lo : lo + _MEET] = both * 100 >= (n[a] + n[b] - both) * PERCENT
    return x[good], y[good]


def _tile_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted tiles to the pairs of ids, the smaller one first, that may be similar enough."""
    release()
    key, parts = None, []  # of the tile at hand, which may go on in the next batch
    found, n_found = [], 0

    def compare() -> None:
        nonlocal n_found
        ids, *columns = (np.concatenate(c) for c in zip(*parts, strict=True))
        x, y = possible_pairs(*columns)
        found.append((np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y])))
        n_found += len(x)
        parts.clear()

    def flush() -> pa.RecordBatch:
        nonlocal n_found
        out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(side), pa.int64()) for side in zip(*found, strict=True)], ["a", "b"])
        found.clear()
        n_found = 0
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("lead", "i", "j")], 1)
        ids, n, components, blocks = (batch.column(c).to_numpy() for c in ("id", "n", "component", "block"))
        bits = batch.column("bitmap").flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
        for lo, hi in zip(starts, np.append(starts[1:], len(ids)), strict=True):
            if parts and key != tuple(keys[lo]):
                compare()
                if n_found >= _FOUND:
                    yield flush()
            key = tuple(keys[lo])
            parts.append([c[lo:hi] for c in (ids, n, components, bits, blocks)])
    if parts:
        compare()
    if found:
        yield flush()


def lead_pairs(followers: DataFrame) -> DataFrame:
    """Each member with the least of its bucket, once."""
    pairs = followers.filter(_alike(F.col("lead_n"), F.col("n")))
    return pairs.select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()


def mixed_groups(followers: DataFrame, labels: DataFrame, classes: DataFrame, tile: int = TILE) -> DataFrame:
    """(lead, id, n, component, blocks, bitmap) of the followers of leads that have some in different components."""
    rows = left_join(followers.select("lead", "id", "n").distinct(), labels, "id", spread=True)
    mixed = rows.groupBy("lead").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / tile).alias("blocks")
    mixed = mixed.filter(F.col("c0") < F.col("c1")).select("lead", F.hash("lead").alias("spread"), blocks)
    rows = rows.withColumn("spread", F.hash("lead")).join(mixed, ["lead", "spread"]).drop("spread")
    bits = classes.select("id", "bitmap").dropDuplicates(["id"])
    return staged(left_join(rows, bits, "id", spread=True).select("lead", "id", "n", "component", "blocks", "bitmap"), "mixed_groups")


def member_tiles(rows: DataFrame) -> DataFrame:
    """(lead, i, j, block, id, n, component, bitmap): the followers of every tile; i and j are the blocks that meet there."""
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    meeting = rows.select("lead", block, other, "id", "n", "component", "bitmap")
    return meeting.select("lead", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "n", "component", "bitmap")


def cross_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of followers of one lead in different components that may be similar, once."""
    spark, key = rows.sparkSession, ["lead", "i", "j"]
    ship(spark)
    dealt = member_tiles(rows).repartition(partitions(spark), *key).sortWithinPartitions(*key)
    return dealt.mapInArrow(_tile_pairs, "a long, b long").distinct()


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) after new links between ids."""
    left, right = (labels.toDF(s, f"component_{s}") for s in "ab")
    edges = links.join(left, "a").join(right, "b").select(F.col("component_a").alias("a"), F.col("component_b").alias("b"))
    joined = components(edges).toDF("component", "least")
    out = left_join(labels, joined, "component", spread=True)
    return staged(out.select("id", F.coalesce("least", "component").alias("component")), "labels")


def linked(classes: DataFrame, names: DataFrame, documents: DataFrame, shingle: int) -> DataFrame:
    """(id, component) of all members of buckets, by all links between candidates."""
    members = bucket_members(classes)
    leads = members.groupBy("key").agg(F.min_by(F.struct("id", "n"), F.struct("id", "n")).alias("least"))
    rows = left_join(members, leads, "key", spread=True).filter(F.col("id") != F.col("least.id"))
    followers = staged(rows.select("id", "n", F.col("least.id").alias("lead"), F.col("least.n").alias("lead_n")).distinct(), "followers")
    tested = staged(lead_pairs(followers), "pairs")
    ids = staged(members.select("id", F.col("id").alias("component")).distinct(), "members")
    labels = relabelled(ids, verified(tested, names, documents, shingle))
    crossed = cross_pairs(mixed_groups(followers, labels, classes))
    more = verified(staged(anti_join(crossed, tested, ["a", "b"]), "pairs"), names, documents, shingle)
    return labels if more.isEmpty() else relabelled(labels, more)


def verified(pairs: DataFrame, names: DataFrame, documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The pairs (a written table) whose full sets are similar enough, as edges."""
    ids = inner_join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), names, "id")
    ids = staged(ids.select("id", "doc_id", "signature"), "pair_ids")
    wanted = F.broadcast(ids.select("doc_id")) if ids.count() <= BROADCAST_IDS else ids
    texts = documents.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    found = texts.mapInArrow(_sets(shingle), "signature binary, shingles array<long>")
    once = found.groupBy("signature").agg(F.first("shingles").alias("shingles"))
    sets = staged(inner_join(ids.select("id", "signature"), once, "signature").select("id", "shingles"), "sets")
    left, right = (sets.toDF(s, f"set_{s}") for s in "ab")
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    joined = pairs.join(left, "a").join(right, "b").filter(both * 100 >= union * PERCENT)
    return staged(joined.select("a", "b").distinct(), "links")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges to (node, component): the least node that is reachable, for each node with an edge.

    Alternates the two star steps: every node hands its larger neighbours to its least neighbour, then its
    smaller ones, until nothing changes. Each result is a written table.
    """
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    state = None
    while True:
        found = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if found == state or not found[0]:
            return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
            )
        state = found
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _star(both, larger=True)
        edges = staged(_star(edges.select(F.col("b").alias("a"), F.col("a").alias("b")), larger=False), "stars")


def _star(rows: DataFrame, larger: bool) -> DataFrame:
    """Rows (node a, neighbour b). Links neighbours, larger or smaller than the node, to the least one."""
    least = rows.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    joined = left_join(rows, least, "a", spread=True)
    if larger:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b")
    else:
        out = joined.select(F.col("m").alias("a"), "b").unionByName(joined.select(F.col("m").alias("a"), F.col("a").alias("b")))
    return out.filter("a < b").distinct()


def labelled(documents: DataFrame, shingle: int) -> DataFrame:
    """ROW, doc_id, n_shingles, class_id (the least class of the component) and component_id of documents with a ROW."""
    sketches = sketched(documents, shingle)
    names = named_classes(sketches)
    labels = linked(representatives(sketches, names), names, documents, shingle)
    classes = left_join(names, labels, "id").select("signature", "doc_id", F.coalesce("component", "id").alias("class_id"))
    least = classes.groupBy("class_id").agg(F.min("doc_id").alias("least"))
    classes = left_join(classes.drop("doc_id"), least, "class_id", spread=True)
    joined = left_join(sketches.drop("bands", "bitmap"), classes, "signature", spread=True)
    known = F.col("doc_id").isNotNull()
    return joined.select(
        ROW,
        "doc_id",
        "n_shingles",
        F.when(known, F.col("class_id")).alias("class_id"),
        F.when(known, F.coalesce("least", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def label(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document; rows that share the least doc_id are all marked kept."""
    rows = documents.select("doc_id", "text").withColumn(ROW, F.monotonically_increasing_id())
    return labelled(rows, shingle).drop(ROW, "class_id")


def deduplicate(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The documents without those that another one of their component stands for; all columns stay.

    One row of each component stays: the one with the least doc_id, of these the one with the least text,
    and of equal ones the first.
    """
    rows = staged(documents.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    found = staged(labelled(rows, shingle).select(ROW, "class_id", "kept"), "labelled")
    first = found.filter("kept and class_id is not null").drop("kept")
    shared = first.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("class_id", F.hash("class_id").alias("spread"))
    rivals = first.withColumn("spread", F.hash("class_id")).join(shared, ["class_id", "spread"], "left_semi").drop("spread")
    rivals = staged(rivals, "rivals")
    least = inner_join(rivals, rows.select(ROW, "text"), ROW).groupBy("class_id").agg(F.min(F.struct("text", ROW)).alias("least"))
    gone = anti_join(rivals.select(ROW), least.select(F.col(f"least.{ROW}").alias(ROW)), ROW)
    gone = staged(found.filter(~F.col("kept")).select(ROW).unionByName(gone), "duplicates")
    wanted = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return rows.join(wanted, ROW, "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
