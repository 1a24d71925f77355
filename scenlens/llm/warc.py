"""WARC archives without repeated payloads: revisit records refer to the original response.

Headers (page, payload digest, size) are grouped by digest; of the pages with one payload of at least
``MIN_BYTES``, that with the largest page_id is the original, and the others become revisit records. The
archives are written anew with fresh headers, each record a gzip member of its own, by Spark's text writer:
a row is one member and the line separator is an empty member, so a file is a plain .warc.gz (named
part-*) in any store that Spark can write to. Reading goes through the members one by one, checks every
payload against its digest, and joins revisit records to their responses for what they lack.

Defined results: a null payload is empty. Null page_ids are smaller than any other. Rows that repeat the
original's page_id and payload are responses like it, so among null page_ids alone all are responses. A
null url is left out of the headers; line breaks in it are percent-encoded. An empty table gives no
records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from scenlens.llm.common import ship
from scenlens.operators.joins import left_join
from scenlens.sources.shared import new_folder, staged

MIN_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
LEVEL = 4

_GZIP = 31  # zlib's window bits for a gzip member
_CHUNK = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = "urn:page:"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

PARSED = "page_id long, uri string, record_type string, refers_to long, payload_digest string, payload_bytes long"


def _uri(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def _labelled(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(page_id: str | None, url: str | None, digest: str, payload: bytes, original: tuple | None, date: str = DATE) -> bytes:
    """The bytes of a response record, or of a revisit record that refers to ``original`` (page_id, url)."""
    head = [
        ("WARC-Type", "revisit" if original else "response"),
        ("WARC-Record-ID", f"<{_PAGE}{page_id}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", _labelled(digest)),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", _uri(url)))
    if original:
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{_PAGE}{original[0]}>"), ("WARC-Refers-To-Date", date)]
        if original[1] is not None:
            head.append(("WARC-Refers-To-Target-URI", _uri(original[1])))
    block = _HTTP.format(len(payload)).encode() + (b"" if original else payload)
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _members(
    page_id: pd.Series, url: pd.Series, digest: pd.Series, payload: pd.Series,
    revisit: pd.Series, o_id: pd.Series, o_url: pd.Series,
) -> pd.Series:
    out = []
    for page, uri, hexed, body, again, o, o_uri in zip(page_id, url, digest, payload, revisit, o_id, o_url, strict=True):
        original = (o, o_uri) if again else None
        out.append(zlib.compress(record(page, uri, hexed, body or b"", original), LEVEL, _GZIP))
    return pd.Series(out, dtype=object)


def headers(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    return rows.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("long"))


def resolve(rows: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Add ``original`` (page_id, url), the response that a row's record refers to; null for responses."""
    seen = rows.filter(F.col("bytes") >= min_bytes).select("digest", F.struct("page_id", "url").alias("at"))
    originals = seen.groupBy("digest").agg(F.max("at").alias("original"), F.count(F.lit(1)).alias("n"))
    originals = originals.filter(F.col("n") > 1).drop("n")
    joined = left_join(rows, originals, "digest", spread=True)
    own = F.col("original.page_id").eqNullSafe(F.col("page_id"))
    return joined.withColumn("original", F.when(F.col("original").isNotNull() & ~own, F.col("original")))


def write_archives(resolved: DataFrame, folder: str) -> None:
    ship(resolved.sparkSession)
    member = F.pandas_udf(_members, "binary")
    # ids go as text, since pandas has no nullable long of its own
    value = member(
        F.col("page_id").cast("string"),
        "url",
        "digest",
        F.when(F.col("original").isNull(), F.col("payload")),
        F.col("original").isNotNull(),
        F.col("original.page_id").cast("string"),
        F.col("original.url"),
    )
    empty = zlib.compress(b"", LEVEL, _GZIP).decode("latin-1")
    (
        resolved.select(value.cast("string").alias("value"))
        .write.option("lineSep", empty)
        .option("encoding", "ISO-8859-1")
        .text(folder)
    )


def _records(content: memoryview) -> Iterator[bytes]:
    """The contents of the gzip members that are not empty."""
    at = 0
    while at < len(content):
        member, parts = zlib.decompressobj(_GZIP), []
        while not member.eof:
            piece = content[at : at + _CHUNK]
            if not piece:
                raise ValueError("the archive ends within a record")
            parts.append(member.decompress(piece))
            at += len(piece)
        at -= len(member.unused_data)
        if data := b"".join(parts):
            yield data


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return fields, rest[: int(fields["content-length"])]


def _page(field: str | None) -> int | None:
    number = (field or "").strip("<>").removeprefix(_PAGE)
    return int(number) if number.lstrip("-").isdigit() else None


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in PARSED.split(", ")]
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for data in _records(memoryview(content.as_buffer())):
                fields, block = parse(data)
                kind = fields["warc-type"]
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                payload = block.partition(b"\r\n\r\n")[2]
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload and digest differ in {fields['warc-record-id']}")
                size = len(payload) if kind == "response" else None
                rows.append((_page(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, _page(fields.get("warc-refers-to")), digest, size))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record; a revisit record has the size of its response's payload."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    records = staged(files.filter(F.col("length") > 0).select("content").mapInArrow(_parsed, PARSED), "records")
    responses = (
        records.filter(F.col("record_type") == "response")
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.max("payload_bytes").alias("referred_bytes"))
    )
    joined = left_join(records, responses, ["refers_to", "payload_digest"], spread=True)
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "referred_bytes")).drop("referred_bytes")


def deduplicate(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write deduplicated archives of ``pages`` (page_id, url, html) and read their records back."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    write_archives(resolve(headers(pages), min_bytes), folder)
    return read_archives(spark, folder)
