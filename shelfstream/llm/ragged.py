"""A bounded per-worker table from strings to token-id runs, with vectorised concatenation."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class RaggedCache:
    """Remembers the ids of strings already encoded and concatenates runs of them in numpy.

    Text repeats its words, so most are encoded once per worker.  The table is emptied when it holds ``limit`` strings or
    ``16 * limit`` ids, which bounds its memory.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[list[int]]], limit: int = 500_000):
        self._encode, self._limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self._where: dict[str, int] = {}
        self._starts, self._flat = np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.int32)
        self._used = 0

    def _add(self, words: list[str]) -> None:
        runs = list(self._encode(words))
        first, ends = len(self._where), self._used + np.cumsum([len(r) for r in runs])
        while first + len(words) >= len(self._starts):
            self._starts = np.resize(self._starts, 2 * len(self._starts))
        while ends[-1] > len(self._flat):
            self._flat = np.resize(self._flat, 2 * len(self._flat))
        self._flat[self._used : ends[-1]] = np.fromiter(chain.from_iterable(runs), np.int32, ends[-1] - self._used)
        self._starts[first + 1 : first + len(words) + 1] = ends
        self._where.update(zip(words, range(first, first + len(words)), strict=True))
        self._used = int(ends[-1])

    def rows(self, strings: list[str]) -> np.ndarray:
        """The table's row of every string, until the next call."""
        if len(self._where) > self._limit or self._used > 16 * self._limit:
            self._clear()
        found = list(map(self._where.get, strings))
        if None in found:
            self._add(list(dict.fromkeys(s for s, known in zip(strings, found, strict=True) if known is None)))
            found = list(map(self._where.get, strings))
        return np.array(found, np.int64)

    def runs(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one behind the other (int32), and how many each row has."""
        return gathered(self._flat, self._starts[rows], self._starts[rows + 1])

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row (int32), and how many each word has."""
        coded = words.dictionary_encode()
        return self.runs(self.rows(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)])

    def encode_lists(self, words: pa.ListArray) -> list[np.ndarray]:
        """Ids of every list of words."""
        return per_list(words, *self.encode(words.flatten()))


def gathered(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices [start, end) of ``flat`` one behind the other, and their lengths."""
    lengths = ends - starts
    upto = np.cumsum(lengths)
    if not len(upto):
        return flat[:0], lengths
    return flat[np.arange(upto[-1], dtype=np.int32) + np.repeat((starts - (upto - lengths)).astype(np.int32), lengths)], lengths


def per_list(words: pa.ListArray, ids: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """The ids of every list, from those of all its words in a row."""
    offsets = words.offsets.to_numpy()
    ends = np.concatenate(([0], np.cumsum(lengths)))[offsets - offsets[0]]
    return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def in_blocks(texts: pa.Array, size: int = 2 << 20) -> Iterator[pa.Array]:
    """Slices of about ``size`` bytes, one text at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size)))
        yield texts.slice(at, upto - at)
        at = upto
