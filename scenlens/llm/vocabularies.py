"""Encoders over the files of public tokenizers, with a bounded cache of words, for code that runs in tasks."""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import cache
from itertools import compress, pairwise

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
os.environ.setdefault("RAYON_NUM_THREADS", "1")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402

CACHED_WORDS = 250_000
CACHED_MARKS = 10_000
JOINED_WORDS = 200
BLOCK_TEXTS = 1024
BLOCK_SIZE = 1 << 21

#: Text in which a single space always starts a new piece has no white space beside white space or at its end.
_SPACE = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NOT_CUT = rf"{_SPACE}{_SPACE}|{_SPACE}\z|\x00"

#: Latin letters, then punctuation: each of the two is one piece.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_TWO_PIECES = re.compile(rf"(\n?)([{_LETTERS}]+)([!-/:-@\[-`{{-~]*)")

#: Words that a normaliser of Unicode neither cuts nor empties, so that joined words can be told apart.
_PLAIN_WORD = re.compile(
    "[!-~À-ʯΈ-ϿЀ-ԯא-תؠ-يऄ-๏"
    "ぁ-ゖァ-ヺー一-鿿가-힣]+"
)


@contextmanager
def no_collection() -> Iterator[None]:
    """For work with millions of short strings and no cycles."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def byte_tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    found.model._resize_cache(0)  # words come here once; what is kept of pieces costs more than it saves
    return found


@cache
def piece_processor(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


@cache
def first_characters(path: str, some: str) -> np.ndarray:
    """For each id of a byte-level vocabulary: does its token start with one of these characters? A space is Ġ, a line end Ċ."""
    vocabulary = byte_tokenizer(path).get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for t, i in vocabulary.items() if t.startswith(tuple(some))]] = True
    return out


def splits_like_gpt2(tokenizer) -> bool:
    from tokenizers import pre_tokenizers

    found = tokenizer.pre_tokenizer
    return tokenizer.normalizer is None and isinstance(found, pre_tokenizers.ByteLevel) and found.use_regex and not found.add_prefix_space


def blocks(texts: list[str]) -> Iterator[list[str]]:
    """Runs of at most BLOCK_TEXTS texts and, but for single longer ones, BLOCK_SIZE characters."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and (i - start >= BLOCK_TEXTS or held + len(t) > BLOCK_SIZE):
            yield texts[start:i]
            start, held = i, 0
        held += len(t)
    if texts[start:]:
        yield texts[start:]


class Cache:
    """Values of words in a task. Words that have not come while CACHED_WORDS others came are learned anew."""

    def __init__(self, learn: Callable[[list], Iterable[tuple]]):
        self.learn = learn
        self.recent: dict = {}
        self.older: dict = {}

    def of(self, words: Iterable) -> dict:
        """A table that holds the values of these words, among others."""
        if len(self.recent) > CACHED_WORDS:
            self.older, self.recent = self.recent, {}
        recent, older = self.recent, self.older
        missing = list(dict.fromkeys([w for w in words if w not in recent]))
        if older:
            again = [w for w in missing if w in older]
            recent.update(zip(again, map(older.__getitem__, again), strict=True))
            missing = [w for w in missing if w not in older]
        for i in range(0, len(missing), JOINED_WORDS):
            recent.update(self.learn(missing[i : i + JOINED_WORDS]))
        return recent


def spaced_ids(tokenizer, starts: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words that each begin with a space, encoded as one text, and where the tokens begin with a space."""
    ids = np.array(tokenizer.encode_batch_fast(["".join(words)], add_special_tokens=False)[0].ids, np.int64)
    return ids, np.flatnonzero(starts[ids])


class TextEncoder:
    """Token ids of whole texts, equal to the tokenizer's own, at the price of their distinct words.

    The tokenizer splits a text into pieces before it merges anything, and a single space between other
    characters always starts a piece. Such texts are cut at their spaces; parts that are new go to the tokenizer
    joined, and their ids are parted again at the tokens that begin with a space, of which each part has one.
    Any other text goes to the tokenizer whole.

    Where the tokenizer splits as GPT-2 did, a single line end is a piece of its own, a run of letters after a
    space or a line end is one piece, and so is punctuation behind it. There texts are cut at line ends too, and
    new words of letters and punctuation go to the tokenizer's model piece by piece; words that share their
    letters share the ids of these.
    """

    def __init__(self, path: str):
        self.tokenizer = byte_tokenizer(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model
        self.in_pieces = splits_like_gpt2(self.tokenizer)
        self.starts = first_characters(path, "ĠĊ" if self.in_pieces else "Ġ")
        self.bytes_of_id = [i.tobytes() for i in np.arange(len(self.starts)).astype(self.dtype)]
        self.known = Cache(self._learn)
        self.marks: dict[str, bytes] = {}  # of punctuation
        if self.in_pieces:
            (space,), (line_end,) = map(self.tokenizer.pre_tokenizer.pre_tokenize_str, " \n")
            self.space, self.line_end = space[0], self._piece(line_end[0])
            letters = [c for c in map(chr, range(0x80, 0x250)) if re.match(f"[{_LETTERS}]", c)]
            self.bytes_of = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _piece(self, piece: str) -> bytes:
        """The ids of a piece, in the characters that stand for its bytes."""
        return b"".join([self.bytes_of_id[t.id] for t in self.model.tokenize(piece)])

    def ids(self, text: str) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        with no_collection():
            return [ids for block in blocks(texts) for ids in self._block(block)]

    def _block(self, texts: list[str]) -> list[bytes]:
        array = pa.array(texts, pa.string())
        cut = pc.invert(pc.match_substring_regex(array, _NOT_CUT))
        joined = iter(self._cut(array.filter(cut)))
        return [next(joined) if c else self._encoded([t])[0] for t, c in zip(texts, cut.to_pylist(), strict=True)]

    def _cut(self, texts: pa.StringArray) -> list[bytes]:
        if self.in_pieces:
            texts = pc.replace_substring(texts, "\n", " \n")
        lists = pc.split_pattern(texts, " ")
        edges, parts = lists.offsets.to_numpy(), lists.values
        is_first = np.zeros(len(parts), bool)
        is_first[edges[:-1]] = True
        coded = parts.filter(pa.array(~is_first)).dictionary_encode()  # all but the first begin with a space or a line end
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.known.of(words)
        ids = pa.array([known[w] for w in words], pa.binary()).take(coded.indices)
        at = np.append(0, np.cumsum(pc.binary_length(ids).to_numpy()))[edges - np.arange(len(edges))].tolist()
        data = ids.buffers()[2].to_pybytes() if len(ids) else b""
        firsts = self._encoded(parts.filter(pa.array(is_first)).to_pylist())
        return [f + data[a:b] for f, (a, b) in zip(firsts, pairwise(at), strict=True)]

    def _learn(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        found = [_TWO_PIECES.fullmatch(w) for w in words] if self.in_pieces else [None] * len(words)
        others = [w for w, m in zip(words, found, strict=True) if m is None]
        yield from zip(others, self._learn_spaced([w if w[:1] == "\n" and self.in_pieces else f" {w}" for w in others]), strict=True)
        known, older, letters = self.known.recent, self.known.older, {}
        for m in filter(None, found):
            line_end, run, marks = m.groups()
            key = line_end + run
            ids = letters.get(key) or known.get(key) or older.get(key)
            if ids is None:
                piece = run if run.isascii() else run.translate(self.bytes_of)
                ids = letters[key] = self.line_end + self._piece(piece) if line_end else self._piece(self.space + piece)
            if marks:
                letters[m.string] = ids + (self.marks.get(marks) or self._marks(marks))
        yield from letters.items()

    def _marks(self, marks: str) -> bytes:
        if len(self.marks) >= CACHED_MARKS:
            self.marks.clear()
        self.marks[marks] = ids = self._piece(marks)
        return ids

    def _learn_spaced(self, parts: list[str]) -> list[bytes]:
        """Encode parts that begin with a space or a line end joined; halves where that fails."""
        if len(parts) <= 1:
            return self._encoded(parts)
        ids, first = spaced_ids(self.tokenizer, self.starts, parts)
        if len(first) != len(parts):
            half = len(parts) // 2
            return self._learn_spaced(parts[:half]) + self._learn_spaced(parts[half:])
        data = ids.astype(self.dtype).tobytes()
        edges = [*(first * self.dtype.itemsize).tolist(), len(data)]
        return [data[a:b] for a, b in pairwise(edges)]


@cache
def text_encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


class Fertility:
    """Per word: its piece ids, the number of its byte-level tokens, and its hash."""

    def __init__(self, piece_path: str, byte_path: str):
        from scenlens.llm.words import word_hashes

        self.pieces = piece_processor(piece_path)
        self.bytes = byte_tokenizer(byte_path)
        self.hashes = word_hashes
        self.known = Cache(self._learn)
        size = self.pieces.get_piece_size()
        self.starts = first_characters(byte_path, "Ġ")
        self.piece_starts = np.fromiter((self.pieces.id_to_piece(i).startswith("▁") for i in range(size)), bool, size)
        self.is_byte = np.fromiter((self.pieces.is_byte(i) for i in range(size)), bool, size)

    def of(self, words: list[bytes]) -> list[tuple[bytes, int, int]]:
        known = self.known.of(words)
        return [known[w] for w in words]

    def _learn(self, new: list[bytes]) -> Iterator[tuple[bytes, tuple[bytes, int, int]]]:
        texts = [w.decode("utf-8", "replace") for w in new]
        plain = [_PLAIN_WORD.fullmatch(t) is not None for t in texts]
        joined = self._joined(list(compress(texts, plain)))
        single = self._one_by_one([t for t, p in zip(texts, plain, strict=True) if not p])
        for w, p, h in zip(new, plain, self.hashes(new).tolist(), strict=True):
            yield w, (*next(joined if p else single), h)

    def _joined(self, texts: list[str]) -> Iterator[tuple[bytes, int]]:
        """Encode words joined by spaces, which is cheaper; where these don't part the words again, one by one."""
        pieces = np.array(self.pieces.encode(" ".join(texts)), "<u4")
        cuts = np.flatnonzero(self.piece_starts[pieces])
        tokens, starts = spaced_ids(self.bytes, self.starts, [f" {t}" for t in texts])
        if not len(cuts) == len(starts) == len(texts):
            return self._one_by_one(texts)
        data = pieces.tobytes()
        edges = [*(cuts * 4).tolist(), len(data)]
        return zip([data[a:b] for a, b in pairwise(edges)], np.diff(starts, append=len(tokens)).tolist(), strict=True)

    def _one_by_one(self, texts: list[str]) -> Iterator[tuple[bytes, int]]:
        ids = [np.array(p, "<u4").tobytes() for p in self.pieces.encode(texts, num_threads=1)] if texts else []
        tokens = self.bytes.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        return zip(ids, [len(t.ids) for t in tokens], strict=True)


@cache
def fertility(piece_path: str, byte_path: str) -> Fertility:
    return Fertility(piece_path, byte_path)


def release(but_for: Callable | None = None) -> None:
    """Drop the word caches but one and hand their memory back, for tasks on a worker that did other work before. Tokenizers stay."""
    held = [f for f in (text_encoder, fertility) if f is not but_for and f.cache_info().currsize]
    for f in held:
        f.cache_clear()
    if held:
        gc.collect()  # an encoder and its cache refer to each other
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):  # the latter has C's allocator give back all that is free
            pool.release_unused()
