"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VNODES`` tokens on a ring of ``CELLS`` cells. A row stands at the cell of its key's
hash and belongs to the next token clockwise. No shard takes more rows than its share; the rows that find
their shard full, those last in ring order on an arc, go on clockwise to the next other shard. The shares
add up to the number of rows, so the counts are at most one apart, and a change of the number of shards
moves little beside what the new shard takes.

The walk needs only the rows of each cell: a table of ``CELLS`` counts, whatever the input. Its outcome is
a list of ring intervals per shard (at most ``CELLS + arcs x shards``), joined back on the cell.

Defined results: a null key is a key of its own. Rows with equal keys stand at one place, and a place that
holds a third of all rows is split over the shards like any other overflow. A null text has 0 bytes and
checksum 0. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scenlens.llm.common import bounded_table, numbered
from scenlens.sources.shared import staged

CELLS = 4096
VNODES = 64
SEED = 0x5EED


def _mixed(x: int) -> int:
    """A fixed 64-bit mix, for the places of the tokens."""
    x = (x + 0x9E3779B97F4A7C15) & (2**64 - 1)
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
    return x ^ (x >> 31)


def tokens(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(cell, shard) in ring order. A shard's tokens don't depend on the number of shards."""
    return sorted((_mixed(SEED + s * 65_537 + v) % CELLS, s) for s in range(shards) for v in range(vnodes))


def preferences(shards: int, vnodes: int = VNODES) -> list[list[int]]:
    """For each cell, the shards in the order in which a walk clockwise meets them."""
    ring = tokens(shards, vnodes)
    found: list[list[int]] = []
    at = 0
    for cell in range(CELLS):
        while at < len(ring) and ring[at][0] < cell:
            at += 1
        met = dict.fromkeys(ring[(at + i) % len(ring)][1] for i in range(len(ring)))
        found.append(list(met))
    return found


def walk(counts: list[int], shards: int, vnodes: int = VNODES) -> list[dict]:
    """Place the rows of each cell, given as counts. Returns intervals of ring positions per shard.

    In round d every row not yet placed stands at the d-th shard that it meets. A shard takes rows in ring
    order until its share is full.
    """
    total = sum(counts)
    free = [total // shards + (s < total % shards) for s in range(shards)]
    order = preferences(shards, vnodes)
    pending, start = [], 0
    for n in counts:
        pending.append([start, start + n])
        start += n
    slots, out = [0] * shards, []
    for d in range(shards):
        for cell, rest in enumerate(pending):
            n, shard = rest[1] - rest[0], order[cell][d]
            if take := min(n, free[shard]):
                out.append({"cell": cell, "lo": rest[0], "hi": rest[0] + take, "shard": shard, "slot0": slots[shard]})
                rest[0] += take
                free[shard] -= take
                slots[shard] += take
    return out


def assign(df: DataFrame, key: str, shards: int = 8, vnodes: int = VNODES) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 within the shard) to ``df``, which should be narrow."""
    spark = df.sparkSession
    ring = F.xxhash64(F.col(key), F.lit(SEED))
    ringed = df.withColumn("ring", ring).withColumn("cell", F.shiftrightunsigned("ring", 52).cast("int"))
    rows = numbered(ringed, ["cell", "ring", key, *[c for c in df.columns if c != key]])
    rows = rows.withColumnRenamed("position", "ring_position")
    counts = [0] * CELLS
    for cell, n in rows.groupBy("cell").count().collect():  # at most CELLS rows
        counts[cell] = n
    placed = bounded_table(spark, walk(counts, shards, vnodes), "cell int, lo long, hi long, shard int, slot0 long")
    at = F.col("ring_position")
    return (
        rows.join(F.broadcast(placed), "cell")  # bounded by CELLS and the shards
        .filter((at >= F.col("lo")) & (at < F.col("hi")))
        .select(*df.columns, "shard", (F.col("slot0") + at - F.col("lo")).alias("slot"))
    )


def document_facts(documents: DataFrame) -> DataFrame:
    """doc_id, size and text_crc32 of each row: all that sharding needs, written once."""
    facts = documents.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    return staged(facts, "document_facts")


def shard_documents(documents: DataFrame, shards: int = 8) -> DataFrame:
    """Each document with its shard and slot; the law is ``rows``: counts at most one apart."""
    return assign(document_facts(documents), "doc_id", shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
