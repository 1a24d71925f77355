"""Shards and index against the tokenizer itself."""

import glob
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from scenlens.llm import token_ids
from scenlens.llm.vocabularies import TextEncoder, byte_tokenizer, public_path
from scenlens.llm.words import mix
from tests.llm.fixtures import no_documents, odd_documents

PATH = public_path(token_ids.VOCABULARY)


def ids_of(text):
    return byte_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids + [token_ids.END_ID]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sé 1.,\n\t  \u0000\x1c#<|endoftext|>")), max_size=40))
def test_encoder_equals_tokenizer(text):
    assert np.frombuffer(TextEncoder(PATH).ids(text), "<u2").tolist() == ids_of(text)[:-1]


def test_encoder_equals_tokenizer_on_documents(spark):
    encoder = TextEncoder(PATH)
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        assert np.frombuffer(encoder.ids(r.text), "<u2").tolist() == ids_of(r.text)[:-1]


def test_parts_are_encoded_once():
    """A part goes to the tokenizer once, joined with others, also where it comes once in a block of texts."""
    encoder, sent = TextEncoder(PATH), []
    tokenizer = encoder.tokenizer

    class Counted:
        def encode_batch_fast(self, some, **options):
            sent.extend(some)
            return tokenizer.encode_batch_fast(some, **options)

    encoder.tokenizer = Counted()
    texts = [f"a once{i}. other{i}, \u4e2d{i}" for i in range(60)]
    want = [ids_of(t)[:-1] for t in texts]
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.many([*texts, ""])[:-1]] == want
    assert len([x for x in sent if x not in ("a", "")]) == 1
    sent.clear()
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.many(texts[::-1])] == want[::-1]
    assert set(sent) == {"a"}


def test_words_share_the_ids_of_their_letters():
    """New words of letters and punctuation cost the tokenizer their new pieces, also behind a line end."""
    encoder, sent = TextEncoder(PATH), []
    model = encoder.model

    class Counted:
        def tokenize(self, piece):
            sent.append(piece)
            return model.tokenize(piece)

    encoder.model = Counted()
    texts = ["x Größe Größe, Größe.%%% Größe.\nGröße, it's 'Größe' Größe2 a-b", "y Größe!.\nGröße.%%%\n'tis Größe,", "z.\nGröße"]
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.many(texts)] == [ids_of(t)[:-1] for t in texts]
    assert sorted(sent) == sorted(["ĠGrÃ¶ÃŁe", "GrÃ¶ÃŁe", ",", ".", ".%%%", "!."])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abß\u0141\u024f\u0250\u00aa\u00d7\u0301é's.,-_\n\n  \t\u0085\u00a0\u20281")), max_size=40))
def test_pieces_equal_the_tokenizers(text):
    assert np.frombuffer(TextEncoder(PATH).ids(text), "<u2").tolist() == ids_of(text)[:-1]


def test_texts_come_to_python_in_small_batches(spark, tmp_path, monkeypatch):
    def sizes(path):
        return lambda batches: (pa.RecordBatch.from_pydict({"value": [f"{b.nbytes},".encode()]}) for b in batches)

    monkeypatch.setattr(token_ids, "_payload", sizes)
    token_ids.write_shards(spark.range(32).selectExpr("id as doc_id", "repeat('a ', 1 << 18) as text"), f"{tmp_path}/s")
    found = [int(x) for f in glob.glob(f"{tmp_path}/s/part-*") for x in open(f, "rb").read().replace(b"\2\0", b"").split(b",") if x]
    assert sum(found) > 16 << 20 and max(found) < 6 << 20


def test_documents_read_back(spark):
    df = odd_documents(spark)
    rows = sorted(df.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    got = sorted(token_ids.write_and_index(df).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    want = sorted((r.doc_id or -1, zlib.crc32(np.array(ids_of(r.text), "<u4").tobytes())) for r in rows)
    assert sorted((r.doc_id or -1, r.ids_crc32) for r in got) == want
    ends = 0
    for r in got:
        assert r.start == ends
        ends += r.n_tokens
    assert ends == sum(len(ids_of(r.text)) for r in rows)


def many_copies(spark):
    """Documents of which one id has most rows, over shards of a few hundred bytes."""
    rows = [(i, f"text {i} " + "word " * (i % 9)) for i in range(200)] + [(77, f"copy {i}") for i in range(300)] + [(None, f"n {i}") for i in range(150)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_keyed_access(spark, tmp_path):
    df = odd_documents(spark)
    token_ids.write_and_index(df, str(tmp_path))
    manifest = token_ids.Manifest(spark.read.parquet(f"{tmp_path}/manifest"))
    keys = spark.createDataFrame([(2, 0), (3, 0), (3, 2), (3, 3), (None, 0), (999, 0), (5, 0), (-4, 0)], "doc_id long, copy long")
    ids = {(r.doc_id, r.copy): r.ids for r in token_ids.fetch(spark, f"{tmp_path}/shards", manifest, keys).collect()}
    texts = {r.doc_id: r.text for r in df.filter("doc_id is null or doc_id <> 12").collect()}
    assert ids == {k: ids_of(texts[k[0]]) for k in [(2, 0), (3, 0), (3, 2), (None, 0), (5, 0)]}
    assert {k: token_ids.get(spark, manifest, *k) for k in ids} == ids
    assert token_ids.get(spark, manifest, 3, 3) is None and token_ids.get(spark, manifest, -4) is None


def test_shards_keep_to_their_bound(spark, tmp_path):
    """Many small shards: copies of one id, and of null, go on from shard to shard."""
    df = many_copies(spark)
    got = token_ids.write_and_index(df, str(tmp_path), shard_bytes=600).collect()
    assert len({r.shard for r in got}) > 8 and len(got) == 650
    assert sorted(r.copy for r in got if r.doc_id == 77) == list(range(301))
    assert sorted(r.copy for r in got if r.doc_id is None) == list(range(150))
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/shards/part-*")]
    assert len(sizes) > 8 and max(sizes) < 6000
    manifest = token_ids.Manifest(spark.read.parquet(f"{tmp_path}/manifest"))
    copies = [token_ids.get(spark, manifest, 77, i) for i in range(0, 301, 20)]
    assert None not in copies and token_ids.get(spark, manifest, 77, 301) is None
    keys = spark.createDataFrame([(77, i) for i in range(303)] + [(None, 149), (None, 150), (5, 0)], "doc_id long, copy long")
    found = {(r.doc_id, r.copy): r.ids for r in token_ids.fetch(spark, f"{tmp_path}/shards", manifest, keys).collect()}
    assert len(found) == 303 and [found[77, i] for i in range(0, 301, 20)] == copies
    texts = Counter(tuple(ids_of(r.text)) for r in df.filter("doc_id = 77").collect())
    assert Counter(tuple(found[77, i]) for i in range(301)) == texts


def test_payload_is_raw(spark, tmp_path):
    """Byte by byte: the ids as they are, then the keys."""
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "\u00ff\u4e2d" * 400)], "doc_id long, text string")
    token_ids.write_shards(df, f"{tmp_path}/s")
    (file,) = [f for f in glob.glob(f"{tmp_path}/s/part-*") if os.path.getsize(f)]
    ids = np.array(sum((ids_of(r.text) for r in df.collect()), []), "<u2").tobytes()
    data = open(file, "rb").read()
    assert data.startswith(ids + np.array([1, 2, 3], "<i8").tobytes() + b"\0\0\0") and data.endswith(token_ids.MAGIC + b"\x02\x00")


def test_a_keyed_read_opens_its_ranges_only(spark, tmp_path):
    """Of a shard of 20,000 documents: the tail, the bits, one entry, and the ids."""
    lengths = np.full(20_000, 50)
    ids = np.arange(20_000)
    end = token_ids.footer(ids, np.zeros(20_000, bool), lengths, 2)
    content = np.repeat(ids % 60_000, 50).astype("<u2").tobytes() + end + b"\x02\x00"
    ranges = []

    def read(at, n):
        ranges.append((at, n))
        return content[at : at + n]

    assert token_ids.Shard(read, len(content)).one(12_345, 0).tolist() == [12_345] * 50
    assert ranges[-1] == (12_345 * 100, 100) and ranges[-2][1] == token_ids.ENTRY.itemsize
    assert sum(n for _, n in ranges) < 20_000 and len(ranges) == 4
    assert token_ids.Shard(read, len(content)).one(20_000, 0) is None


def test_a_lost_key_fails(spark, tmp_path):
    ids, none = np.arange(100), np.zeros(100, bool)
    end = token_ids.footer(ids, none, np.full(100, 3), 2)
    content = bytearray(bytes(600) + end + b"\x02\x00")
    assert len(token_ids.shard_of(bytes(content)).rows()[0]) == 100
    entry = 600 + 900 + 7 * token_ids.ENTRY.itemsize
    content[entry] ^= 1  # the fingerprint of one key
    with pytest.raises(ValueError, match="lost 1 of 100 keys"):
        token_ids.shard_of(bytes(content)).rows()
    content[entry] ^= 1
    content[entry + 4] ^= 1  # its offset
    with pytest.raises(ValueError, match="make up"):
        token_ids.shard_of(bytes(content)).rows()
    token_ids.write_shards(many_copies(spark), f"{tmp_path}/s")
    (file,) = [f for f in glob.glob(f"{tmp_path}/s/part-*") if os.path.getsize(f)]
    data = bytearray(open(file, "rb").read())
    shard = token_ids.shard_of(bytes(data))
    data[shard._entries] ^= 1
    os.remove(os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc"))
    open(file, "wb").write(data)
    with pytest.raises(Exception, match="lost 1 of 650 keys"):
        token_ids.read_records(spark, f"{tmp_path}/s").collect()


def test_no_rows(spark):
    assert token_ids.write_and_index(no_documents(spark)).collect() == []


def test_hash_is_perfect_and_minimal():
    a = mix(np.arange(20_000, dtype=np.uint64))
    b = mix(a) | np.uint64(1)
    levels, number = token_ids.build_hash(a, b)
    assert sorted(number) == list(range(20_000))
    assert (token_ids.find_numbers(levels, a, b) == number).all()
    assert sum(len(x) for x in levels) < 4.5 * 20_000


def test_keys_that_no_level_can_part():
    a = np.array([5, 5, 9], np.uint64)
    levels, number = token_ids.build_hash(a, np.ones(3, np.uint64))
    assert sorted(number) == [0, 1, 2] and len(levels) == token_ids.MAX_LEVELS
