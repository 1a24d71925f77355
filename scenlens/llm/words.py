"""Words and their hashes, as numpy arrays, for code that runs in tasks.

Words are runs of bytes other than ASCII white space; ``bytes.split`` and ``bytes.lower`` know just that
white space and just A-Z.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def split_words(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts, coded by their distinct values, and where each text's words begin and end."""
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
    some = pc.greater(pc.binary_length(lists.values), 0)  # white space at an end leaves an empty word
    edges = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))[lists.offsets.to_numpy()]
    return lists.values.filter(some).dictionary_encode(), edges


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of each element (splitmix64)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, offsets: list[int]) -> np.ndarray:
    """One hash for each window, of the words at ``offsets`` from its start; empty if none fits."""
    n = len(hashes) - offsets[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for o in offsets:
        out = mix(out ^ hashes[o : o + n])
    return out
