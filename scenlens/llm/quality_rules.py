"""Quality rules by tokeniser fertility, over base rules on words and lines.

Two public vocabularies measure every text: characters per byte-level token, characters per piece, the
share of pieces that are bytes (byte fallback) and the entropy of the pieces. A language (a script where
the language is unknown) and a size class (powers of two of the number of pieces) share a band, taken from
all documents: in the middle the median, with a spread from the median to the upper quartile, which junk on
the low side moves little. Below the median a text may fall by ``LOWER`` spreads; above it by ``UPPER``
times the median, since well-known words make long tokens. A text is rejected for one measure outside its
band, or for more byte pieces than ``BYTES`` and the language's upper quartile allow.

A group of fewer than ``MIN_DOCUMENTS`` takes its band from the neighbouring size classes of the language too,
as many on each side as it needs; where the whole language has too few, from all documents of the script in
the same way. A script with too few has the fixed bands ``FIXED``; other scripts would say nothing about it.

Base rules: fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEATED`` percent of the words in repeated
five-word windows.

Words are runs of characters other than ASCII white space.

Defined results: a null or empty text has no words, fails the base rules and is rejected. Each row is
judged on its own text and language. An empty table gives no rows. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scenlens.llm.common import ship
from scenlens.llm.vocabularies import Fertility, blocks, fertility, no_collection, public_path, release
from scenlens.llm.words import encoded, split_words, window_hashes
from scenlens.sources.shared import staged

PIECES = "piece_bpe_32k.model"
BYTES_VOCABULARY = "byte_bpe_50k.json"
MIN_WORDS = 10
MAX_REPEATED = 20
WINDOW = 5
LOWER = 4.0
UPPER = 2.5
BYTES = 0.2
MIN_DOCUMENTS = 50
MIN_SPREAD = 0.01
CLASSES = (6, 14)

MEASURES = ("chars_per_token", "chars_per_piece", "entropy")
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MEASURED = f"{BASE}, n_pieces long, chars_per_token double, chars_per_piece double, byte_share double, entropy double, script string"

_SPACES = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"

# Bands where a script has too few documents: what a text of any language keeps to.
FIXED = {"chars_per_token": (0.25, 12.0), "chars_per_piece": (0.25, 12.0), "entropy": (1.5, 16.0)}
FIXED_LATIN = {"chars_per_token": (1.2, 12.0), "chars_per_piece": (0.8, 12.0), "entropy": (1.5, 16.0)}

# Unicode blocks that tell scripts apart.
_SCRIPTS = [
    ("latin", "AZ", "az", "Àɏ"),
    ("greek", "Ͱ\u03ff"),
    ("cyrillic", "Ѐӿ"),
    ("hebrew", "\u0590\u05ff"),
    ("arabic", "\u0600\u06ff"),
    ("indic", "\u0900\u0dff"),
    ("thai", "\u0e00\u0e7f"),
    ("kana", "\u3040\u30ff"),
    ("hangul", "\uac00\ud7a3"),
    ("han", "\u4e00\u9fff"),
]
_SCRIPT_AT = np.zeros(0x10001, np.uint8)  # the last slot is for all that lies above
for _i, (_, *_blocks) in enumerate(_SCRIPTS):
    for _lo, _hi in _blocks:
        _SCRIPT_AT[ord(_lo) : ord(_hi) + 1] = _i + 1


def script_of(text: str) -> str:
    """The script with the most letters; ``none`` without letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    counts = np.bincount(_SCRIPT_AT[np.minimum(points, 0x10000)], minlength=len(_SCRIPTS) + 1)[1:]
    most = int(np.argmax(counts))
    return _SCRIPTS[most][0] if counts[most] else "none"


def repeated_words(windows: np.ndarray, n: int) -> int:
    """Words of a text of ``n`` that stand in a window found twice or more; ``windows`` has their hashes."""
    ordered = np.sort(windows)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def repeated_lines(data: bytes) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in data.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip(b" \t\x0b\x0c\r"):
            seen.add(line)
    return n


def measure(text: str | None, lang: str | None, piece_path: str, byte_path: str) -> tuple:
    return measures([text], piece_path, byte_path)[0]


def measures(texts: Iterable[str | None], piece_path: str, byte_path: str) -> list[tuple]:
    """The measures of each text. Words are looked up for a block of texts together."""
    release(but_for=fertility)
    known = fertility(piece_path, byte_path)
    with no_collection():
        return [row for block in blocks([t or "" for t in texts]) for row in _block(block, known)]


def _block(texts: list[str], known: Fertility) -> Iterator[tuple]:
    data = [encoded(t) for t in texts]
    coded, edges = split_words(data)
    at = coded.indices.to_numpy()
    found = known.of(coded.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist())
    ids, tokens, hashes = zip(*found, strict=True) if found else ((), (), ())
    windows = window_hashes(np.array(hashes, np.uint64)[at], list(range(WINDOW)))
    pieces = np.frombuffer(b"".join([ids[i] for i in at.tolist()]), "<u4")
    n_tokens, n_pieces = (np.append(0, np.cumsum(np.array(x, np.int64)[at]))[edges].tolist() for x in (tokens, [len(i) // 4 for i in ids]))
    edges = edges.tolist()
    for i, text in enumerate(texts):
        a, b = edges[i], edges[i + 1]
        yield _row(text, data[i], b - a, windows[a : max(a, b - WINDOW + 1)], pieces[n_pieces[i] : n_pieces[i + 1]], n_tokens[i + 1] - n_tokens[i], known)


def _row(text: str, data: bytes, n_words: int, windows: np.ndarray, pieces: np.ndarray, n_tokens: int, known: Fertility) -> tuple:
    word_chars = len(text) - len(data) + len(data.translate(None, _SPACES))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    base = n_words, word_chars, symbols, repeated_lines(data), repeated_words(windows, n_words)
    script = script_of(text)
    if not len(pieces):
        return *base, 0, None, None, None, None, script
    counts = np.bincount(pieces)
    share = counts[counts > 0] / len(pieces)
    return (
        *base,
        len(pieces),
        word_chars / max(1, n_tokens),
        word_chars / len(pieces),
        float(known.is_byte[pieces].mean()),
        float(-(share * np.log2(share)).sum()),
        script,
    )


def _measures(piece_path: str, byte_path: str):
    names = [f.split()[0] for f in MEASURED.split(", ")]

    def run(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(measures(text, piece_path, byte_path), columns=names)

    return F.pandas_udf(run, MEASURED)


def base_failed(m: str) -> Column:
    n = F.col(f"{m}.n_words")
    return (n < MIN_WORDS) | (F.col(f"{m}.n_repeat_words") * 100 > n * MAX_REPEATED)


def measured(documents: DataFrame, name: str = "__quality", piece_path: str | None = None, byte_path: str | None = None) -> DataFrame:
    """``documents`` with a struct of measures; ``text`` is read."""
    ship(documents.sparkSession)
    udf = _measures(piece_path or public_path(PIECES), byte_path or public_path(BYTES_VOCABULARY))
    return documents.withColumn(name, udf("text"))


def _group(lang: Column, m: str) -> list[Column]:
    size = F.floor(F.log2(F.greatest(F.col(f"{m}.n_pieces"), F.lit(1))))
    size = F.least(F.greatest(size, F.lit(CLASSES[0])), F.lit(CLASSES[1]))
    script = F.concat(F.lit("script "), F.col(f"{m}.script"))
    kind = F.when(F.coalesce(lang, F.lit("")) != "", F.concat(F.lit("language "), lang)).otherwise(F.concat(F.lit("no language, "), script))
    return [kind.alias("kind"), script.alias("script"), size.cast("int").alias("size_class")]


def _reach(cells: DataFrame, name: str) -> DataFrame:
    """(name, size_class, reach): how many size classes on each side make up MIN_DOCUMENTS; null where all are too few."""
    sizes = cells.groupBy(name, "size_class").agg(F.sum("documents").alias("n"))
    sizes = sizes.groupBy(name).agg(F.collect_list(F.struct("size_class", "n")).alias("sizes"))
    reaches = range(CLASSES[1] - CLASSES[0] + 1)

    def within(r: int) -> Column:
        near = F.filter("sizes", lambda x: F.abs(x["size_class"] - F.col("size_class")) <= r)
        return F.aggregate(near, F.lit(0).cast("long"), lambda acc, x: acc + x["n"])

    least = F.coalesce(*[F.when(within(r) >= MIN_DOCUMENTS, F.lit(r)) for r in reaches])
    rows = cells.select(name, "size_class").distinct().join(sizes, name)
    return rows.select(name, "size_class", least.alias(f"{name}_reach"))


def _fixed(values: dict) -> Column:
    return F.struct(*[F.struct(F.lit(values[c][0]).alias("lo"), F.lit(values[c][1]).alias("hi")).alias(c) for c in MEASURES])


def bands(rows: DataFrame, m: str = "__quality") -> DataFrame:
    """(kind, script, size_class, band, byte_share) for all cells of rows that pass the base rules."""
    passed = rows.filter(~base_failed(m)).select(*_group(F.col("lang"), m), *[F.col(f"{m}.{c}") for c in (*MEASURES, "byte_share")])
    cells = staged(passed.groupBy("kind", "script", "size_class").agg(F.count(F.lit(1)).alias("documents")), "cells")
    chosen = cells.join(_reach(cells, "kind"), ["kind", "size_class"]).join(_reach(cells, "script"), ["script", "size_class"])
    group = F.when(F.col("kind_reach").isNotNull(), F.col("kind")).when(F.col("script_reach").isNotNull(), F.col("script"))
    chosen = staged(chosen.select("kind", "script", "size_class", group.alias("group"), F.coalesce("kind_reach", "script_reach").alias("reach")), "chosen")
    wanted = chosen.filter("group is not null").select("group", F.col("size_class").alias("middle"), "reach").distinct()
    wanted = staged(wanted, "wanted_bands")
    both = passed.select(F.explode(F.array("kind", "script")).alias("group"), "size_class", *MEASURES, "byte_share")
    near = both.join(wanted, "group").filter(F.abs(F.col("size_class") - F.col("middle")) <= F.col("reach"))
    middle = [F.percentile_approx(c, [0.5, 0.75], 2000).alias(c) for c in (*MEASURES, "byte_share")]
    found = near.groupBy("group", F.col("middle").alias("size_class")).agg(*middle)
    out = []
    for c in MEASURES:
        mid, high = F.get(c, 0), F.get(c, 1)
        spread = F.greatest((high - mid) / 0.6745, mid * MIN_SPREAD)
        out.append(F.struct((mid - spread * LOWER).alias("lo"), (mid * UPPER).alias("hi")).alias(c))
    most = F.greatest(F.lit(BYTES), F.get("byte_share", 1) * 3).alias("most")
    found = found.select("group", "size_class", F.struct(*out).alias("found"), most)
    latin = F.col("script") == "script latin"
    return chosen.join(found, ["group", "size_class"], "left").select(
        "kind",
        "script",
        "size_class",
        F.coalesce("found", F.when(latin, _fixed(FIXED_LATIN)).otherwise(_fixed(FIXED))).alias("band"),
        F.coalesce("most", F.when(latin, F.lit(BYTES)).otherwise(F.lit(1.0))).alias("byte_share"),
    )


def judged(rows: DataFrame, m: str = "__quality") -> DataFrame:
    """Add ``__failed`` (base rules) and ``__kept`` to measured rows, which should be a written table."""
    keys = ("__kind", "__script", "__class")
    table = staged(bands(rows, m), "bands").toDF(*keys, "__band", "__bytes")
    joined = rows.withColumns(dict(zip(keys, _group(F.col("lang"), m), strict=True))).join(table, list(keys), "left")
    inside = F.col(f"{m}.byte_share") <= F.col("__bytes")
    for c in MEASURES:
        value = F.col(f"{m}.{c}")
        inside = inside & (value >= F.col(f"__band.{c}.lo")) & (value <= F.col(f"__band.{c}.hi"))
    kept = ~F.col("__failed") & F.coalesce(inside, F.lit(False))
    out = joined.withColumn("__failed", F.coalesce(base_failed(m), F.lit(True)))
    return out.withColumn("__kept", kept).drop(*keys, "__band", "__bytes")


def verdicts(documents: DataFrame) -> DataFrame:
    """doc_id, the base measures, the verdicts, and all that the vocabularies measure."""
    rows = staged(measured(documents.select("doc_id", "text", "lang")).drop("text"), "quality")
    m = "__quality"
    return judged(rows, m).select(
        "doc_id",
        *[F.col(f"{m}.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("__failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
        *[F.col(f"{m}.{c}") for c in ("n_pieces", *MEASURES, "byte_share")],
    )


def filtered(documents: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    rows = judged(staged(measured(documents), "quality_documents"))
    return rows.filter("__kept").select(*[F.col(f"`{c}`") for c in documents.columns])
