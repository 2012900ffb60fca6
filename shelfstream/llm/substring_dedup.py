"""Substring dedup over words, with difference-cover anchors.

Anchors are the word positions whose residue modulo v lies in a difference cover; each is named by the words of the window
that fits behind any shift below v.  Two equal windows have a shift that brings both to anchors of one name.  Anchors
that no other place shares are dropped; around the others, every full window is named and compared, which extends a
shared anchor to exactly the windows that repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F

from shelfstream.llm.repeats import (
    HASH_BLOCK, READ_IN_PIECES, Pack, answered_map, covered_runs, difference_cover, discard, read_answers, window_names, word_keys,
    write_large_rows, write_packs,
)
from shelfstream.session import fresh_path

WINDOW = 50
NO_ID = np.iinfo(np.int64).max
SENT_BYTES = 1 << 20  # of kept text in a batch of results, about
REGION_SCHEMA = "pack long, docs array<long>, lengths array<long>, data binary, region array<long>, n_windows long"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _cover(window: int) -> tuple[int, tuple[int, ...]]:
    fitting = [q for q in (2, 3, 5, 7, 11, 13) if 3 * (q * q + q + 1) <= 2 * window]
    if not fitting:
        return 1, (0,)
    return difference_cover(fitting[-1])


class Words:
    """The words of a pack: byte spans, owning document, end of each document's words, and word names."""

    def __init__(self, pack: Pack):
        data = pack.data
        inside = ~_BLANK[data]
        edge = pack.ends[pack.ends < len(data)]  # a word also ends where its document ends
        bound = np.ones(len(data), bool)
        bound[1:] = ~inside[:-1]
        bound[edge] = True
        self.first = np.flatnonzero(inside & bound).astype(np.int32)
        bound[:-1] = ~inside[1:]
        bound[-1:] = True
        bound[edge[edge > 0] - 1] = True
        self.last = (np.flatnonzero(inside & bound) + 1).astype(np.int32)
        del inside, bound
        self.ends = np.searchsorted(self.first, pack.ends)
        self.owner = np.repeat(np.arange(len(pack.docs), dtype=np.int32), np.diff(self.ends, prepend=0))
        self.keys = word_keys(data, self.first, self.last)
        self.doc_ids = np.array([NO_ID if d is None else d for d in pack.docs], np.int64)

    def fits(self, at: np.ndarray, length: int) -> np.ndarray:
        """Whether a window of ``length`` words at each position lies in one document."""
        return at + length <= self.ends[self.owner[at]]

    def ids(self, at: np.ndarray) -> np.ndarray:
        return self.doc_ids[self.owner[at]]

    def names(self, at: np.ndarray, length: int) -> np.ndarray:
        """Names of the windows at ascending positions; works in blocks, so little more than the names is held."""
        out = np.empty(len(at), np.uint64)
        low = 0
        while low < len(at):
            first = int(at[low])
            high = int(np.searchsorted(at, first + HASH_BLOCK))
            block = self.keys[first : int(at[high - 1]) + length]
            out[low:high] = window_names(block, 1, at[low:high] - first, length)
            low = high
        return out


def _smallest(names: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names with the smallest id of each, how many windows a name has, and the order that sorts the windows by name."""
    order = np.argsort(names)
    names = names[order]
    first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1]))) if len(names) else np.empty(0, np.int64)
    keys = names[first]
    del names
    least = np.minimum.reduceat(ids[order], first) if len(first) else np.empty(0, np.int64)
    return keys, least, np.diff(first, append=len(order)), order


def _joined_words(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> bytes:
    """The words [first, last), ascending, with one blank between."""
    if not len(first):
        return b""
    start, stop = int(first[0]), int(last[-1])
    part = data[start:stop].copy()
    part[last[:-1] - start] = 0x20  # the white space behind a word
    step = np.zeros(len(part) + 1, np.int8)
    step[first - start] = 1
    step[np.minimum(last + 1 - start, len(part))] -= 1  # the next word may begin there
    return part[np.cumsum(step[:-1], dtype=np.int8) > 0].tobytes()


def remove_repeated_windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Rows of the schema ``RESULT``: every document with its words left, joined by one blank, in ``kept``.

    Removed is each word covered by a window of ``window`` words that also starts in a document with a smaller id.  Words
    are runs of anything but ASCII white space; null counts as no words; a null id is larger than any other.
    """
    spark = docs.sparkSession
    v, residues = _cover(window)
    anchor = window - v + 1
    packs, counted, packed = write_packs(docs, text, doc_id)
    anchors = counted // 6 * len(residues) // v  # about six bytes a word

    def at_cover(words: Words) -> np.ndarray:
        at = (np.arange(0, len(words.first), v, dtype=np.int64)[:, None] + np.sort(residues)).ravel()
        at = at[at < len(words.first)]
        return at[words.fits(at, anchor)]

    def anchor_names(row: dict) -> tuple[np.ndarray, None]:
        words = Words(Pack(row))
        return np.unique(words.names(at_cover(words), anchor)), None

    def region(row: dict) -> Iterator[pa.RecordBatch]:
        pack = Pack(row)
        words = Words(pack)
        at = at_cover(words)
        keys, index, counts = np.unique(words.names(at, anchor), return_inverse=True, return_counts=True)
        shared = at[((counts > 1) | read_answers(row, keys, anchors))[index]]
        step = np.zeros(len(words.first) + 1, np.int32)
        np.add.at(step, np.maximum(np.concatenate(([0], words.ends))[words.owner[shared]], shared - v + 1), 1)
        np.add.at(step, shared + 1, -1)
        starts = np.flatnonzero(np.cumsum(step[:-1], dtype=np.int32) > 0)
        starts = starts[words.fits(starts, window)]
        edges = np.flatnonzero(np.diff(np.concatenate(([-2], starts))) != 1)
        bounds = np.column_stack((starts[edges], starts[np.append(edges[1:], len(starts)) - 1] + 1)).ravel() if len(starts) else starts
        yield pa.RecordBatch.from_pylist([{
            "pack": row["pack"], "docs": row["docs"], "lengths": row["lengths"], "data": row["data"],
            "region": bounds.tolist(), "n_windows": len(starts),
        }], schema=arrow_region)

    arrow_region = pa.schema([
        ("pack", pa.int64()), ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("data", pa.binary()),
        ("region", pa.list_(pa.int64())), ("n_windows", pa.int64()),
    ])
    seen, path = Observation(), fresh_path(spark, "word-regions")
    regions = answered_map(packs, anchor_names, anchors, region, arrow_region, REGION_SCHEMA)
    write_large_rows(regions.observe(seen, F.sum("n_windows").alias("windows")), path)
    discard(spark, packed)
    found = spark.read.options(**READ_IN_PIECES).parquet(path)
    windows = seen.get["windows"] or 0

    def starts_of(row: dict) -> np.ndarray:
        bounds = np.array(row["region"], np.int64).reshape(-1, 2)
        return np.concatenate([np.empty(0, np.int64), *[np.arange(a, b) for a, b in bounds]]).astype(np.int64)

    def repeated_names(row: dict) -> tuple[np.ndarray, np.ndarray]:
        at = starts_of(row)
        if not len(at):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        words = Words(Pack(row))
        keys, least, _, _ = _smallest(words.names(at, window), words.ids(at))
        return keys, least

    def cut(row: dict) -> Iterator[pa.RecordBatch]:
        pack = Pack(row)
        words, at = Words(pack), starts_of(row)
        keys, least, counts, order = _smallest(words.names(at, window), words.ids(at))
        repeated = np.empty(len(at), bool)
        repeated[order] = np.repeat(read_answers(row, keys, windows), counts)
        repeated[order] |= np.repeat(least, counts) < words.ids(at[order])
        gone = np.zeros(len(words.first), bool)
        for first, last in zip(*covered_runs(at[repeated], window), strict=True):
            gone[first:last] = True
        del keys, least, counts, order, at
        out, held = [], 0
        for key, low, high in zip(pack.docs, np.concatenate(([0], words.ends[:-1])), words.ends, strict=True):
            stay = np.flatnonzero(~gone[low:high]) + low
            kept = _joined_words(pack.data, words.first[stay], words.last[stay])
            out.append({
                "doc_id": key, "n_words": int(high - low), "n_removed": int(high - low - len(stay)),
                "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept.decode("utf-8", "replace"),
            })
            held += len(kept)
            if held > SENT_BYTES:
                yield pa.RecordBatch.from_pylist(out, schema=arrow_result)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow_result)

    arrow_result = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string()),
    ])
    return answered_map(found, repeated_names, windows, cut, arrow_result, RESULT)
