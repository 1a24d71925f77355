"""Token ids in raw binary shards, each with a minimal perfect hash index for keyed access.

A shard is one file: the ids of its documents, each followed by the end id, as little-endian unsigned
integers (16 bits where the vocabulary fits, else 32); then its index. Documents are in ascending order of
doc_id, nulls first, over the shards in the order of their names. The number of shards follows from the
bytes of the texts, ``SHARD_BYTES`` for each, so a shard can be read whole by one task.

Spark's text writer writes the files: a row is the bytes of a document, cast to a string, and the line
separator is the end id itself, so the payload is raw and any store that Spark can write to holds it. That
rests on the writer leaving bytes as they are; a test reads the files back byte by byte.

The index of a shard maps the key (doc_id, n), the n-th row with that id in the shard, to its offset and
length in the payload. It is a minimal perfect hash: on each level the keys that are alone at their place of
a bit array are done, the others go on to the next; a key's rank among the bits is its number, and the entry
with that number holds a fingerprint, so that a foreign key is refused. Boundaries of documents stand
nowhere else: every read cuts the payload at what the index returns, and fails if a key is lost or the cuts
don't make up the payload.

A manifest, one row for each shard, tells by its first key which shard holds a key. One key is read with
seeks for the shard's bits, one entry and the ids' own range; many keys are joined to their shards.

Defined results: a null or empty text is the end id alone. A null doc_id is a key like others. Rows with
equal doc_ids are copies 0, 1, ... in the order of the files; a doc_id that a third of the rows share is
spread over shards. An empty table gives no files and a manifest without rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from scenlens.llm.common import settings, ship
from scenlens.llm.vocabularies import byte_tokenizer, public_path, release, text_encoder
from scenlens.llm.words import mix
from scenlens.sources.shared import new_folder, staged

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
SHARD_BYTES = 16 << 20  # of text
READ_BYTES = 64 << 20  # of shards, by one task
BATCH_BYTES = 4 << 20  # of texts or, but for single larger ones, shards that a task hands to Python at once
GAMMA = 1.7
MAX_LEVELS = 48

MAGIC = b"IDSHARD2"
ENTRY = np.dtype([("fingerprint", "<u4"), ("offset", "<i8"), ("length", "<i8")])
TAIL = np.dtype([("n", "<i8"), ("width", "<i8"), ("ids", "<i8"), ("levels", "<i8"), ("bit_bytes", "<i8"), ("magic", "S8")])

RECORD = "shard long, doc_id long, repeat long, offset long, n_tokens long, ids_crc32 long"


# Minimal perfect hash


def _hashes(doc_id: np.ndarray, null: np.ndarray, copy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids = np.where(null, mix(np.full(len(doc_id), 0xA5A5, np.uint64)), doc_id.astype(np.uint64))
    copies = copy.astype(np.uint64) * np.uint64(2) + null.astype(np.uint64)
    return mix(mix(ids) ^ copies), mix(mix(ids ^ np.uint64(0x1234567)) + copies) | np.uint64(1)


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(a + np.uint64(level) * b) % np.uint64(size)).astype(np.int64)


def build_hash(a: np.ndarray, b: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays of the levels, and the number of each key; keys that no level places are numbered last."""
    levels, left, number = [], np.arange(len(a)), np.full(len(a), -1)
    done = 0
    while len(left) and len(levels) < MAX_LEVELS:
        size = max(8, int(GAMMA * len(left)))
        at = _place(a[left], b[left], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        rank = np.cumsum(alone) - 1
        good = alone[at]
        number[left[good]] = done + rank[at[good]]
        done += int(good.sum())
        levels.append(alone)
        left = left[~good]
    number[left] = done + np.arange(len(left))
    return levels, number


def find_numbers(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of each key; -1 where no level has a bit for it."""
    number, left, done = np.full(len(a), -1), np.arange(len(a)), 0
    for i, bits in enumerate(levels):
        at = _place(a[left], b[left], i, len(bits))
        good = bits[at]
        number[left[good]] = done + (np.cumsum(bits) - 1)[at[good]]
        done += int(bits.sum())
        left = left[~good]
    return number


class Index(NamedTuple):
    levels: list[np.ndarray]
    entries: np.ndarray


def _prints(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (mix(a ^ b) & np.uint64(0xFFFFFFFF)).astype("<u4")


def built_index(doc_id: np.ndarray, null: np.ndarray, lengths: np.ndarray) -> Index:
    """The index of rows in their order."""
    a, b = _hashes(doc_id, null, _repeats(doc_id, null))
    levels, number = build_hash(a, b)
    entries = np.zeros(len(a), ENTRY)
    entries["fingerprint"][number] = _prints(a, b)
    entries["offset"][number] = np.cumsum(lengths) - lengths
    entries["length"][number] = lengths
    return Index(levels, entries)


def _repeats(doc_id: np.ndarray, null: np.ndarray) -> np.ndarray:
    """For sorted rows: how many rows before have the same key."""
    at = np.arange(len(doc_id))
    fresh = np.ones(len(doc_id), bool)
    fresh[1:] = (doc_id[1:] != doc_id[:-1]) | (null[1:] != null[:-1])
    return at - np.maximum.accumulate(np.where(fresh, at, 0))


def places(index: Index, doc_id: np.ndarray, null: np.ndarray, copy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, found) of each key: its entry, and whether the index has it."""
    a, b = _hashes(doc_id, null, copy)
    number, prints = find_numbers(index.levels, a, b), _prints(a, b)
    placed = sum(int(x.sum()) for x in index.levels)
    for i in np.flatnonzero(number < 0):  # keys that no level placed stand behind the others
        same = np.flatnonzero(index.entries["fingerprint"][placed:] == prints[i])
        number[i] = placed + same[0] if len(same) else -1
    found = number >= 0
    entries = np.zeros(len(a), ENTRY)
    entries[found] = index.entries[number[found]]
    return entries, found & (entries["fingerprint"] == prints)


# Shards


def footer(doc_id: np.ndarray, null: np.ndarray, lengths: np.ndarray, width: int) -> bytes:
    """Keys in order, entries, sizes and bits of the levels, and the tail."""
    index = built_index(doc_id, null, lengths)
    bits = b"".join(np.packbits(x).tobytes() for x in index.levels)
    sizes = np.array([len(x) for x in index.levels], "<i8")
    tail = np.array([(len(doc_id), width, int(lengths.sum()), len(sizes), len(bits), MAGIC)], TAIL)
    return doc_id.astype("<i8").tobytes() + null.astype("u1").tobytes() + index.entries.tobytes() + sizes.tobytes() + bits + tail.tobytes()


class Shard:
    """A shard behind a function that reads (offset, length) of its file; only what is asked for is read."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        for width in (2, 4):  # of the separator behind the tail
            tail = np.frombuffer(read(size - width - TAIL.itemsize, TAIL.itemsize), TAIL)[0]
            if tail["magic"] == MAGIC and tail["width"] == width:
                break
        else:
            raise ValueError("no shard of token ids")
        self.read, self.n, self.width, self.ids = read, int(tail["n"]), width, int(tail["ids"])
        self._keys = self.ids * width
        self._entries = self._keys + 9 * self.n
        self._sizes = self._entries + ENTRY.itemsize * self.n
        self._levels, self._bit_bytes = int(tail["levels"]), int(tail["bit_bytes"])

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """doc_id and null of all rows in order."""
        data = self.read(self._keys, 9 * self.n)
        return np.frombuffer(data, "<i8", self.n), np.frombuffer(data, "u1", self.n, 8 * self.n).astype(bool)

    def levels(self) -> list[np.ndarray]:
        data = self.read(self._sizes, 8 * self._levels + self._bit_bytes)
        at, out = 8 * self._levels, []
        for size in np.frombuffer(data, "<i8", self._levels).tolist():
            taken = -(-size // 8)
            out.append(np.unpackbits(np.frombuffer(data, "u1", taken, at), count=size).astype(bool))
            at += taken
        return out

    def index(self) -> Index:
        return Index(self.levels(), np.frombuffer(self.read(self._entries, ENTRY.itemsize * self.n), ENTRY))

    def one(self, doc_id: int | None, copy: int) -> np.ndarray | None:
        """The ids of one key: reads the bits, one entry, and the ids' range; keys that no level placed need the rest."""
        levels = self.levels()
        a, b = _hashes(np.array([doc_id or 0]), np.array([doc_id is None]), np.array([copy]))
        number, placed = int(find_numbers(levels, a, b)[0]), sum(int(x.sum()) for x in levels)
        some = (number, 1) if number >= 0 else (placed, self.n - placed)
        entries = np.frombuffer(self.read(self._entries + ENTRY.itemsize * some[0], ENTRY.itemsize * some[1]), ENTRY)
        for entry in entries[entries["fingerprint"] == _prints(a, b)[0]]:
            return self.cut(int(entry["offset"]), int(entry["length"]))
        return None

    def cut(self, offset: int, length: int) -> np.ndarray:
        return np.frombuffer(self.read(offset * self.width, length * self.width), f"<u{self.width}")

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc_id, null and entry of all rows in order, through the index; fails if it has lost one."""
        doc_id, null = self.keys()
        entries, found = places(self.index(), doc_id, null, _repeats(doc_id, null))
        if not found.all():
            raise ValueError(f"the index of a shard has lost {int((~found).sum())} of {self.n} keys")
        ends = entries["offset"] + entries["length"]
        if self.n and (entries["offset"][0] != 0 or ends[-1] != self.ids or (entries["offset"][1:] != ends[:-1]).any()):
            raise ValueError("the index of a shard doesn't make up its ids")
        return doc_id, null, entries


def shard_of(content: bytes | memoryview) -> Shard:
    return Shard(lambda at, n: content[at : at + n], len(content))


def _payload(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(but_for=text_encoder)
        encoder = text_encoder(path)
        ids: list[np.ndarray] = []
        nulls: list[np.ndarray] = []
        lengths: list[int] = []
        width = encoder.dtype.itemsize
        for batch in batches:
            rows = encoder.many([t or "" for t in batch.column("text").to_pylist()])
            keys = batch.column("doc_id")
            ids.append(keys.fill_null(0).to_numpy(zero_copy_only=False))
            nulls.append(keys.is_null().to_numpy(zero_copy_only=False))
            lengths += [len(r) // width + 1 for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])
        if lengths:
            end = footer(np.concatenate(ids), np.concatenate(nulls), np.array(lengths), width)
            yield pa.RecordBatch.from_arrays([pa.array([end], pa.binary())], ["value"])

    return run


def write_shards(
    documents: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES
) -> None:
    """Encode the texts of ``documents`` (doc_id, text) and write the shards to ``folder``."""
    spark, path = documents.sparkSession, path or public_path(VOCABULARY)
    ship(spark)
    width = 2 if byte_tokenizer(path).get_vocab_size() <= 1 << 16 else 4
    size = documents.agg(F.sum(F.octet_length("text") + F.lit(8)).alias("bytes")).first()["bytes"] or 0
    order = ["doc_id", "tie"]
    rows = (
        documents.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("tie"))
        .repartitionByRange(max(1, math.ceil(size / shard_bytes)), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(_payload(path), "value binary")
    )
    with settings(spark, **{"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}):
        (
            rows.select(F.col("value").cast("string").alias("value"))
            .write.option("lineSep", end_id.to_bytes(width, "little").decode("latin-1"))
            .option("encoding", "ISO-8859-1")
            .option("maxRecordsPerFile", 0)
            .text(folder)
        )


# Reading


def _files(spark: SparkSession, folder: str) -> DataFrame:
    name = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.filter(F.col("length") > 0).select(name.alias("shard"), "path", "content")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
            shard = shard_of(memoryview(content.as_buffer()))
            doc_id, null, entries = shard.rows()
            crcs = [zlib.crc32(shard.cut(o, n).astype("<u4")) for o, n in zip(entries["offset"].tolist(), entries["length"].tolist(), strict=True)]
            columns = [np.full(shard.n, number), pa.array(doc_id, mask=null), _repeats(doc_id, null), entries["offset"], entries["length"], crcs]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [f.split()[0] for f in RECORD.split(", ")])


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document that the shards hold, found through their indexes, with the checksum of its ids."""
    ship(spark)
    return _files(spark, folder).select("shard", "content").mapInArrow(_records, RECORD)


def write_manifest(records: DataFrame, shards: str, folder: str) -> DataFrame:
    """One row for each shard, written: shard, file, the key of its first row, and how many ids stand before it."""
    spark = records.sparkSession
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id")
    per_id = records.groupBy("shard", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("ids"))
    per_shard = per_id.groupBy("shard").agg(
        F.sum("ids").alias("ids"), F.min(order).alias("first"), F.max(order).alias("last"), F.max_by("n", order).alias("n_last")
    )
    known = per_shard.select("shard", "ids", F.col("first.doc_id").alias("first_id"), F.col("last.doc_id").alias("last_id"), "n_last")
    by_shard = Window.orderBy("shard")  # one row per file
    running = known.withColumn("running", F.sum("n_last").over(Window.partitionBy("last_id").orderBy("shard")))
    before = F.lag(F.struct("last_id", "running")).over(by_shard)
    goes_on = before.isNotNull() & before["last_id"].eqNullSafe(F.col("first_id"))
    firsts = running.select(
        "shard",
        "first_id",
        F.when(goes_on, before["running"]).otherwise(F.lit(0)).alias("first_copy"),
        F.coalesce(F.sum("ids").over(by_shard.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
    )
    files = _files(spark, shards).select("shard", F.col("path").alias("file"))
    firsts.join(files, "shard").coalesce(1).write.parquet(folder)
    return spark.read.parquet(folder)


def placed(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add to the records ``copy``, a row's number among those with its doc_id, and ``start``, its place in all ids."""
    bases = manifest.select("shard", "first_id", "first_copy", F.col("start").alias("base"))
    joined = records.join(F.broadcast(bases), "shard")  # one row per file
    before = F.when(F.col("doc_id").eqNullSafe(F.col("first_id")), F.col("first_copy")).otherwise(F.lit(0))
    return joined.select(*records.columns, (before + F.col("repeat")).alias("copy"), (F.col("base") + F.col("offset")).alias("start"))


# Keyed access


class Manifest:
    """The first keys of all shards, for the driver and for tasks: a few dozen bytes for each shard of SHARD_BYTES."""

    def __init__(self, table: DataFrame):
        rows = table.orderBy("shard").select("shard", "file", "first_id", "first_copy").collect()
        self.firsts = [self._order(r.first_id, r.first_copy) for r in rows]
        self.shards, self.files = [r.shard for r in rows], [r.file for r in rows]
        self.keys = [(r.first_id, r.first_copy) for r in rows]

    @staticmethod
    def _order(doc_id: int | None, copy: int) -> tuple:
        return doc_id is not None, doc_id or 0, copy

    def find(self, doc_id: int | None, copy: int) -> tuple[int, int]:
        """(place in the manifest, copy within that shard); place -1 where all shards begin later."""
        from bisect import bisect_right

        at = bisect_right(self.firsts, self._order(doc_id, copy)) - 1
        return at, copy - (self.keys[at][1] if at >= 0 and self.keys[at][0] == doc_id else 0)


def _reader(spark: SparkSession, file: str) -> tuple[Callable[[int, int], bytes], int]:
    """A function that reads a byte range of a file in any store that Spark reads, and the file's size."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def read(at: int, n: int) -> bytes:
        stream = store.open(path)
        try:
            stream.seek(at)
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n)) if n else b""
        finally:
            stream.close()

    return read, store.getFileStatus(path).getLen()


def get(spark: SparkSession, manifest: Manifest, doc_id: int | None, copy: int = 0) -> list[int] | None:
    """The ids of one key, by seeks; null where no shard holds it."""
    at, inside = manifest.find(doc_id, copy)
    if at < 0:
        return None
    found = Shard(*_reader(spark, manifest.files[at])).one(doc_id, inside)
    return None if found is None else found.tolist()


def fetch(spark: SparkSession, folder: str, manifest: Manifest, keys: DataFrame) -> DataFrame:
    """doc_id, copy and ids of the keys (doc_id, copy) that the shards in ``folder`` hold; only shards with keys are read."""
    ship(spark)
    known = spark.sparkContext.broadcast(manifest)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("copy").to_pylist(), strict=True))
            found = [known.value.find(*r) for r in rows]
            columns = [[known.value.shards[at] if at >= 0 else None for at, _ in found], *zip(*rows, strict=True), [c for _, c in found]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["shard", "doc_id", "copy", "inside"])

    def cut(key: tuple, files: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        shard = shard_of(files["content"].iloc[0])
        null = wanted["doc_id"].isna().to_numpy()
        ids = wanted["doc_id"].fillna(0).to_numpy(np.int64)
        entries, found = places(shard.index(), ids, null, wanted["inside"].to_numpy(np.int64))
        out = wanted.loc[found, ["doc_id", "copy"]].copy()
        out["doc_id"] = out["doc_id"].astype("Int64")
        out["ids"] = [shard.cut(int(e["offset"]), int(e["length"])).astype(np.int64).tolist() for e in entries[found]]
        return out

    routed = staged(
        keys.select(F.col("doc_id").cast("long"), F.col("copy").cast("long")).mapInArrow(route, "shard long, doc_id long, copy long, inside long"),
        "routed_keys",
    ).filter("shard is not null")
    files = _files(spark, folder).drop("path").join(routed.select("shard").distinct(), "shard", "left_semi")
    return files.groupBy("shard").cogroup(routed.groupBy("shard")).applyInPandas(cut, "doc_id long, copy long, ids array<long>")


def write_and_index(documents: DataFrame, folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write shards and their manifest, then find every document through the index and read its ids back."""
    spark = documents.sparkSession
    folder = folder or new_folder(spark, "token_ids")
    write_shards(documents, f"{folder}/shards", shard_bytes=shard_bytes)
    with settings(spark, **{"spark.sql.files.maxPartitionBytes": READ_BYTES, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}):
        records = staged(read_records(spark, f"{folder}/shards"), "token_records")
    return placed(records, write_manifest(records, f"{folder}/shards", f"{folder}/manifest")).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "copy", "shard", "offset"
    )
