"""Words of many texts at once, as dictionary codes over Arrow buffers."""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_SPACE = b" \t\n\x0b\x0c\r"
_LOWER = bytes(range(65, 91))

#: Byte maps: A-Z to lower case; and that with all ASCII but letters and digits turned to spaces.
KEEP = bytes(range(256))
LOWER = bytes(b + 32 if b in _LOWER else b for b in range(256))
ALNUM = bytes((b + 32 if b in _LOWER else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def mapped(texts: pa.Array, table: bytes) -> pa.Array:
    """The texts (null: empty) after a map of single bytes that keeps every length."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if table is KEEP or len(texts) == 0:
        return texts
    texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    body = bytes(memoryview(data)[offsets[0] : offsets[-1]]) if data is not None else b""
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(body.translate(table)))


def split(texts: pa.Array, table: bytes = KEEP) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(ends, codes, vocabulary): words of text i are ``vocabulary[codes[ends[i]:ends[i + 1]]]``.

    Words are the runs without the bytes 20 and 09-0D (hex).
    """
    listed = pc.ascii_split_whitespace(mapped(texts, table))
    if len(listed) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.int64), pa.array([], pa.large_string())
    ends = np.asarray(listed.offsets, dtype=np.int64)
    flat = listed.flatten().dictionary_encode()
    ends = ends - ends[0]
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.index(flat.dictionary, "").as_py()
    if empty >= 0:  # leading and trailing space give empty strings
        real = codes != empty
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
        codes = codes[real]
    return ends, codes, flat.dictionary


def hashes(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit hash of each entry."""
    return np.fromiter((xxhash.xxh3_64_intdigest(x) for x in vocabulary.to_pylist()), np.uint64, len(vocabulary))


def window_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` words, by mixing in one word at a time."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = mix((h * np.uint64(0x9E3779B97F4A7C15)) ^ word_hashes[i : i + n])
    return h


def mix(h: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit avalanche hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


class Memo:
    """The ids of strings, by a function from many strings to (number of ids of each, all ids), remembered up to ``most`` strings."""

    def __init__(self, fresh: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 500_000) -> None:
        self.fresh, self.most = fresh, most
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.size, self.data, self.n, self.end = np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.uint32), 0, 0

    def _keep(self, vocabulary: list[str]) -> None:
        """Forget all strings but those that are asked for again now, half of the room at most."""
        stay = [w for w in vocabulary if w in self.known][: self.most // 2]
        total, ids = self._ids(np.fromiter(map(self.known.__getitem__, stay), np.int64, len(stay)))
        self._clear()
        self._add(stay, np.diff(total), ids)

    def _add(self, strings: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self._room(self.n + len(strings), self.end + len(ids))
        self.size[self.n : self.n + len(strings)] = sizes
        self.data[self.end : self.end + len(ids)] = ids
        self.known.update(zip(strings, range(self.n, self.n + len(strings)), strict=True))
        self.n, self.end = self.n + len(strings), self.end + len(ids)

    def _room(self, n: int, end: int) -> None:
        for name, least in (("size", n), ("data", end)):
            own = getattr(self, name)
            if len(own) < least:
                setattr(self, name, np.concatenate([own, np.zeros(max(least - len(own), len(own)), own.dtype)]))

    def expand(self, vocabulary: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where the ids of each code start, and the end; all ids) of a sequence of codes of ``vocabulary``."""
        if self.n + len(vocabulary) > self.most and self.n:
            self._keep(vocabulary)
        at = np.fromiter(map(self.known.get, vocabulary, itertools.repeat(-1)), np.int64, len(vocabulary))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            fresh = [vocabulary[i] for i in missing.tolist()]
            at[missing] = np.arange(self.n, self.n + len(fresh))
            self._add(fresh, *self.fresh(fresh))
        return self._ids(at[codes])

    def _ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = np.cumsum(self.size[: self.n]) - self.size[: self.n]
        return gathered(self.data, begin[at], self.size[at])


def gathered(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each part starts, and the end; all parts) of the parts data[begin : begin + size]."""
    total = np.concatenate([[0], np.cumsum(size)])
    short = np.int32 if max(total[-1], len(data)) < 1 << 31 else np.int64
    return total, data[np.arange(total[-1], dtype=short) + np.repeat((begin - total[:-1]).astype(short), size)]
