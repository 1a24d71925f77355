"""Sharding, mixing, quality rules, licenses and line dedup against brute force on odd rows."""

import random
import re
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenlens.llm import licenses, line_dedup, mixing, quality_rules, sharding
from tests.llm.fixtures import SCHEMA, clean_text, no_documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Sharding


def test_shards_of_odd_rows(spark):
    df = odd_documents(spark)
    rows = df.collect()
    got = sharding.shard_documents(df).collect()
    facts = [(r.doc_id or -1, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows]
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(facts)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1


def test_walk_equals_one_key_at_a_time():
    """Keys in rounds: each stands at its next shard and is taken while there is room."""
    rng = random.Random(5)
    counts = [rng.choice([0, 0, 1, 3]) for _ in range(sharding.CELLS)]
    counts[77] += sum(counts) // 2
    total, order = sum(counts), sharding.preferences(8)
    free = [total // 8 + (s < total % 8) for s in range(8)]
    cells = [c for c, n in enumerate(counts) for _ in range(n)]
    at = [None] * total
    for d in range(8):
        for i, cell in enumerate(cells):
            if at[i] is None and free[order[cell][d]]:
                at[i] = order[cell][d]
                free[at[i]] -= 1
    got = [None] * total
    for s in sharding.walk(counts, 8):
        for i in range(s["lo"], s["hi"]):
            assert got[i] is None
            got[i] = s["shard"]
    assert got == at


def test_one_more_shard_moves_little(spark):
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    old = {r.doc_id: r.shard for r in sharding.assign(df, "doc_id", 8).collect()}
    new = {r.doc_id: r.shard for r in sharding.assign(df, "doc_id", 9).collect()}
    moved = sum(old[i] != new[i] for i in old) / len(old)
    assert 1 / 9 - 0.01 <= moved < 0.35
    assert Counter(new.values()).most_common()[-1][1] == 444


def test_hot_key_is_spread(spark):
    df = spark.createDataFrame([(7 if i % 3 else i,) for i in range(900)], "doc_id long")
    sizes = Counter(r.shard for r in sharding.assign(df, "doc_id").collect())
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 1


# Mixing


def test_mix_of_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, clean_text(rng, rng.randrange(0, 80)), None, rng.choice(["a", "b", "c", "d", None, "z"]), 0, 0, 0, 0) for i in range(200)]
    rows += [(None, "x y z", None, "a", 0, 0, 0, 0), rows[5], (900, None, None, "empty", 0, 0, 0, 0), (901, clean_text(rng, 3000), None, "é", 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    share, target, open_ = 1.5 * sum(sizes.values()), {s: 0.0 for s in sizes}, set(sizes)
    while open_:  # reshare the excess by weight until none is above
        level = (share - sum(target[s] for s in sizes if s not in open_)) / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] >= 2 * sizes[s]}
        target.update({s: 2.0 * sizes[s] if s in full else level * weights[s] for s in (full or open_)})
        open_ = open_ - full if full else set()
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * (1 + share)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) < 1 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df).collect()))


def test_mixed_documents(spark):
    df = odd_documents(spark)
    taken = Counter()
    for r in mixing.mix(df).collect():
        taken[r.doc_id] += int(r.taken / r.size + 0.5) if r.size else 0
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +taken


# Quality rules


def base(text):
    words, seen, dup = WORD.findall(text or ""), set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_base_rules(spark):
    df = odd_documents(spark)
    extra = ["a b c d e f a b c d e", "x\n x\nx\n\n \n\nx", "## $ <b>|é x y", "w " * 30, "é" * 9]
    more = spark.createDataFrame([(500 + i, t, None, None, 1, 1, 1, 1) for i, t in enumerate(extra)], SCHEMA)
    rows = df.unionByName(more)
    want = Counter()
    for r in rows.collect():
        b = base(r.text)
        want[r.doc_id, *b, b[0] < 10 or 100 * b[4] > 20 * b[0]] += 1
    got = quality_rules.verdicts(rows).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert all(not r.kept for r in got if r.base_failed) and all(r.kept for r in got if not r.base_failed)  # no bands


def test_measures_of_a_text():
    from scenlens.llm.vocabularies import byte_tokenizer, piece_processor, public_path

    pieces, tokens = public_path(quality_rules.PIECES), public_path(quality_rules.BYTES_VOCABULARY)
    text = "the cat sat on the mat 乐\U00012000 the end"
    m = quality_rules.measure(text, None, pieces, tokens)
    ids = [i for w in text.split() for i in piece_processor(pieces).encode(w)]
    n = sum(len(byte_tokenizer(tokens).encode(" " + w, add_special_tokens=False).ids) for w in text.split())
    chars = len(text.replace(" ", ""))
    assert m[5:8] == (len(ids), chars / n, chars / len(ids)) and m[10] == "latin"
    assert m[8] == pytest.approx(sum(piece_processor(pieces).is_byte(i) for i in ids) / len(ids)) and m[8] > 0
    assert quality_rules.script_of("привет мир ok") == "cyrillic" and quality_rules.script_of("12 34") == "none"


def test_words_measured_together_equal_one_by_one(spark):
    from scenlens.llm.vocabularies import Fertility, public_path

    pieces, tokens = public_path(quality_rules.PIECES), public_path(quality_rules.BYTES_VOCABULARY)
    known = Fertility(pieces, tokens)
    odd = ["a\u00a0b", "\u2581x", "\u3000", "\ufb01x", "don't", "x\u2003", "''", "<s>", "<|endoftext|>"]
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in [*texts, " ".join(odd), *odd, "a " + odd[0]]:
        words = text.encode().split()
        got = known.of(words)
        for w, (ids, n, _) in zip(words, got, strict=True):
            assert list(map(int, __import__("numpy").frombuffer(ids, "<u4"))) == known.pieces.encode(w.decode())
            assert n == len(known.bytes.encode(" " + w.decode(), add_special_tokens=False).ids)


def test_words_that_normalising_cuts_or_empties():
    """One word in two runs of pieces and one without pieces, learned together with others."""
    from scenlens.llm.vocabularies import Fertility, public_path

    known = Fertility(public_path(quality_rules.PIECES), public_path(quality_rules.BYTES_VOCABULARY))
    words = "first a\u00a0b \u3000 last \ufdfa \u200b x\u2581y привет 中文 \u0301e".encode().split(b" ")
    for w, (ids, n, _) in zip(words, known.of(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == known.pieces.encode(w.decode())
        assert n == len(known.bytes.encode(" " + w.decode(), add_special_tokens=False).ids)


def test_texts_share_calls_of_the_tokenizers(monkeypatch):
    """New words of many texts are encoded together; a text's measures don't depend on the texts beside it."""
    from scenlens.llm.vocabularies import Fertility, public_path

    paths = public_path(quality_rules.PIECES), public_path(quality_rules.BYTES_VOCABULARY)
    texts = [f"one{i} two{i}, three{i} " * 3 + "\u3000 a\u00a0b\n\x0b" for i in range(300)] + ["", " ", None, "  x\t"]
    alone = [quality_rules.measure(t, None, *paths) for t in texts]
    known, calls = Fertility(*paths), []
    encoder = known.bytes

    class Counted:
        def encode_batch_fast(self, some, **options):
            calls.append(len(some))
            return encoder.encode_batch_fast(some, **options)

    known.bytes = Counted()
    monkeypatch.setattr(quality_rules, "fertility", lambda *_: known)
    assert quality_rules.measures(texts, *paths) == alone
    assert len(calls) < 30


def test_words_that_come_again_are_kept(monkeypatch):
    from scenlens.llm import vocabularies

    monkeypatch.setattr(vocabularies, "CACHED_WORDS", 10)
    learned = []
    cache = vocabularies.Cache(lambda new: [(w, learned.append(w) or len(w)) for w in new])
    for i in range(100):
        assert cache.of([f"new {i}", "often", "often"])["often"] == 5
        assert len(cache.recent) + len(cache.older) < 30
    assert learned.count("often") == 1 and len(learned) == 101


def test_tasks_drop_word_caches_of_other_work():
    """The workers of a pipeline go on from stage to stage; what one stage learnt of words must not fill the memory of the next."""
    from scenlens.llm import near_dup, token_ids, vocabularies

    paths = [vocabularies.public_path(n) for n in (quality_rules.PIECES, quality_rules.BYTES_VOCABULARY)]

    def held(task):
        quality_rules.measure("some words of a text", None, *paths)
        known = weakref.ref(vocabularies.fertility(*paths))
        vocabularies.text_encoder(paths[1]).ids("some words of a text")
        task()
        return known() is not None, vocabularies.text_encoder.cache_info().currsize

    assert held(lambda: list(near_dup._sketches(2)(iter([])))) == (False, 0)
    assert held(lambda: list(near_dup._sets(2)(iter([])))) == (False, 0)
    assert held(lambda: list(token_ids._payload(paths[1])(iter([])))) == (False, 1)
    assert held(lambda: quality_rules.measure("others", None, *paths)) == (True, 0)


def test_split_words():
    from scenlens.llm.words import split_words

    texts = [b"", b" a  b\t\n", b"\x0b\x0c\r", "é\u00a0x\u3000y \x1c z\x85".encode(), b"a", b"\xed\xa0\x80 q"]
    coded, edges = split_words(texts)
    words = [bytes(x.as_buffer()) for x in coded.cast("string")] if len(coded) else []
    assert [words[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)] == [t.split() for t in texts]
    assert split_words([])[1].tolist() == [0]


def test_bands_reject_junk_and_keep_clean(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = quality_rules.verdicts(documents).filter("not base_failed").join(labels, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert n[1, True] / (n[1, True] + n[1, False]) > 0.99
    assert n[0, False] / (n[0, True] + n[0, False]) > 0.75


def test_thin_groups_are_judged(spark):
    """Gibberish falls, and prose stays, where a size class or a whole language has few documents."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    texts = [r.text for r in docs.filter("lang = 'en' and quality = 1 and n_chars between 600 and 1000").orderBy("doc_id").limit(90).collect()]
    rng = random.Random(9)

    def gibberish(n):
        return " ".join("".join(rng.choice("qxzjkvwbpQXZJ0123456789") for _ in range(rng.randrange(3, 9))) for _ in range(n))

    rows = [(i, t, "en") for i, t in enumerate(texts[:85])]
    rows += [(100, gibberish(100), "en"), (101, gibberish(2000), "en"), (102, gibberish(100), "xx"), (103, gibberish(60), None)]
    rows += [(200 + i, t, "xx") for i, t in enumerate(texts[85:])]
    got = {r.doc_id: r for r in quality_rules.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert len(got) == len(rows) and not any(got[i].base_failed for i in range(100, 104))
    assert {i for i, r in got.items() if not r.kept and not r.base_failed} == {100, 101, 102, 103}


# Licenses


def test_license_scan(spark):
    texts = {
        0: "Foo. Licensed under CC BY-NC 4.0.",
        1: "This work is licensed under the GNU General Public License, version 3.",
        2: "ALL RIGHTS\nRESERVED all rights reserved",
        3: "cc-by CC by cc  BY",
        4: None,
        5: "nothing here, general public",
        6: "Permission is hereby granted, free of any charge, to any person obtaining one copy of this software and associated documentation files",
        7: "Released under the MIT Licence",
        8: " ".join(f"x{i}" for i in range(3000)) + " Released under the MIT License. é",
        9: "Kind cc İby",
    }
    rows = [(i, t, None, None, 1, 1, 1, 1) for i, t in texts.items()]
    got = licenses.scan(spark.createDataFrame([*rows, rows[0], (None, texts[2], None, None, 1, 1, 1, 1)], SCHEMA)).collect()
    assert len(got) == len(rows) + 2
    by = {r.doc_id: r for r in got}
    assert (by[0].labels, by[0].base_labels, by[0].n_base, by[0].first_word, by[0].score) == ("cc-by,cc-by-nc", "cc-by", 1, 3, 1.0)
    assert (by[1].labels, by[1].n_base, by[1].n_words) == ("gpl", 1, 12)
    assert (by[2].labels, by[2].n_base, by[2].first_word, by[2].last_word) == ("reserved", 2, 0, 3)
    assert (by[3].base_labels, by[3].n_base, by[3].last_word) == ("cc-by", 3, 4)
    assert (by[4].n_words, by[4].n_base, by[4].first_word, by[4].labels, by[4].score) == (0, 0, None, "", 0.0)
    assert (by[5].labels, by[5].n_base) == ("", 0)
    assert by[6].labels == "mit" and by[6].score == 19 / 20
    assert by[7].labels == "mit" and by[7].score == 0.8
    assert (by[5].score, by[9].score) == (0.0, 0.0)
    assert by[8].labels == "mit" and by[8].n_words == 3006
    assert (by[9].n_base, by[None].n_base) == (0, 2)
    assert sum(r.doc_id == 0 and r.labels == "cc-by,cc-by-nc" for r in got) == 2


def test_license_words(spark):
    """Texts are cut between words, which costs a tenth of extracting each word; both ends of a text may be no word."""
    texts = ["", " ", "A", " a", "a ", ", A-b. ", "x\0y", "İby ſ\u212a É", "\U00012000 \U00012000a", "\x7f[`{@/:", "Ab9\n\n\r zZ", "\u00a0", "日本語。a-b", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", licenses.words(F.col("text")).alias("words"))
    assert {r.i: r.words for r in rows.collect()} == {i: licenses.template_words(t or "") for i, t in enumerate(texts)}
    assert "regexp_extract_all" not in rows._jdf.queryExecution().optimizedPlan().toString()


def scanned(spark, texts):
    return {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}


def test_one_changed_word_keeps_the_label(spark):
    """Each word of each template is replaced once, between words that are no part of it; without its name it is no find."""
    texts, want = [], []
    for label, words, names in licenses.TEMPLATES:
        for i in range(len(words)):
            changed = [*words[:i], "other", *words[i + 1 :]]
            texts.append(" ".join(["x1", "x2", *changed, "x3", "x4"]))
            want.append((label, (len(words) - 1) / len(words), words[i] not in names or words.count(words[i]) > 1))
    got = scanned(spark, texts)
    for i, (label, share, named) in enumerate(want):
        found = label in got[i].labels.split(",")
        assert (found and got[i].score >= share) if named else not found or label in got[i].base_labels, (texts[i], got[i])
    assert sum(not named for _, _, named in want) == 8
    (other,) = scanned(spark, ["released under the apache license, licensed under cc by nd 4.0"]).values()
    assert other.labels == "cc-by" and other.score == 0.5


def test_words_put_in_or_left_out_keep_a_span(spark):
    """A word put in or left out moves the rest to a neighbouring diagonal; both are merged."""
    words = next(w for label, w, _ in licenses.TEMPLATES if label == "bsd")
    got = scanned(spark, [" ".join([*words[:9], "extra", *words[9:]]), " ".join([*words[:9], *words[10:]]), " ".join([*words[:9], *["extra"] * 9, *words[9:]])])
    assert (got[0].labels, got[0].score) == ("bsd", 1.0) and (got[1].labels, got[1].score) == ("bsd", 20 / 21)
    assert got[2].labels == "" and got[2].score == 12 / 21


def test_whole_license_texts(spark):
    """A text is found as itself, with its notices, and not as its neighbours, which share sentences with it."""
    got = scanned(spark, [" ".join(["(c) 2020 A. B.", *w]) for _, w, _ in licenses.TEMPLATES])
    whole = {label: got[i].labels for i, (label, w, _) in enumerate(licenses.TEMPLATES) if len(w) > 60}
    assert whole == {
        "mit": "mit", "bsd-2-clause": "bsd,bsd-2-clause", "bsd-3-clause": "bsd,bsd-3-clause", "isc": "isc", "unlicense": "unlicense",
        "zlib": "zlib", "apache-2.0": "apache-2.0", "gpl": "gpl",
    }
    assert all(r.score == 1.0 for r in got.values())


def test_a_text_of_thousands_of_notices(spark):
    notice = "Released under the MIT license. "
    (row,) = scanned(spark, [notice * 5000]).values()
    assert (row.labels, row.score, row.n_words) == ("mit", 1.0, 25_000)


# Lines


def test_site_lines(spark):
    def page(i, *lines):
        return i, f"https://u@Site{i % 2}.org:80/x?{i}", "<html><script>a\nb</script>" + "<br>".join(lines) + "</html>", "h", 5

    rows = [page(i, "menu", f"text {i} ", "menu", "&amp;") for i in range(20)]
    rows += [(50, None, None, "h", 5), (51, "no host", "<!-- c -->a", "h", 5), (None, rows[0][1], "", "h", 5), rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, n_lines long")
    got = line_dedup.drop_boilerplate(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert (by[1].host, by[1].host_pages, by[1].n_lines, by[1].n_dropped, by[1].text) == ("site1.org", 10, 4, 3, "text 1")
    assert (by[0].host_pages, by[0].n_dropped, by[0].text) == (12, 3, "text 0")
    assert (by[50].host, by[50].n_lines, by[50].text, by[51].text, by[None].n_lines) == ("", 0, None, "a", 0)


def test_no_rows(spark):
    empty = no_documents(spark)
    assert sharding.shard_documents(empty).collect() == []
    assert mixing.mix(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []
    assert quality_rules.verdicts(empty).collect() == [] and quality_rules.filtered(empty).columns == empty.columns
    assert licenses.scan(empty).collect() == []
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert line_dedup.drop_boilerplate(pages).collect() == []
