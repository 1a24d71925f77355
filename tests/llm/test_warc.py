"""Archives: round trips and roles."""

import glob
import gzip
import hashlib

import pytest

from scenlens.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, bytes int"


def rows():
    big, other = "é\r\n\r\nWARC/1.1\r\n" * 100, "y" * 1000
    out = [(i, f"http://h/{i}", big if i % 3 else other, "x", 1) for i in range(20)]
    out += [(50, None, "small", "x", 1), (51, "u\r\nEvil: 1", "small", None, None), (52, "u", None, "x", 1), (53, "u", "", "x", 1)]
    return [*out, out[19], out[3], (None, "n", big, "x", 1), (60, "z", "z" * 300_000, "x", 1)]


def expected(data):
    payloads = [((h or "").encode(), p) for p, _, h, *_ in data]
    last = {b: max((q for c, q in payloads if c == b and q is not None), default=None) for b, _ in payloads}
    out = []
    for body, p in payloads:
        again = len(body) >= 1000 and p != last[body]
        out.append((p, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", last[body] if again else None))
    return sorted(out, key=str)


def test_records_read_back(spark):
    got = warc.deduplicate(spark.createDataFrame(rows(), SCHEMA)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows())
    assert {r.uri for r in got if r.page_id in (50, 51)} == {None, "u%0D%0AEvil: 1"}


def test_files_are_gzip_members_without_repeated_payloads(spark, tmp_path):
    pages = spark.createDataFrame(rows(), SCHEMA)
    warc.write_archives(warc.resolve(warc.headers(pages)), f"{tmp_path}/a")
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/a/part-*"))
    assert data.count(b"WARC-Type: revisit") == sum(x[3] == "revisit" for x in expected(rows()))
    assert data.count(b"z" * 300_000) == 1 and data.count(b"y" * 1000) == 1
    assert data.endswith(b"\r\n\r\n")


def test_damage_is_noticed():
    import zlib

    record = warc.record("1", "u", hashlib.sha1(b"abc").hexdigest(), b"abc", None)
    member = zlib.compress(record, 4, 31)
    assert list(warc._records(memoryview(member * 3))) == [record] * 3
    with pytest.raises(ValueError):
        list(warc._records(memoryview(member[:-9])))
    with pytest.raises(ValueError):
        warc.parse(b"HTTP/1.1\r\n\r\n")


def test_no_rows(spark):
    assert warc.deduplicate(spark.createDataFrame([], SCHEMA)).collect() == []
