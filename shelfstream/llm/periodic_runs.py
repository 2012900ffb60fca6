"""Periodic run detection over words: direct lag scans for short periods, multi-scale minimizers for all others.

A run is a stretch of consecutive words of one document in which words one period apart are identical, as long as it can be.

* Periods below ``SHORTEST``: the words are compared with themselves shifted by the period.
* Longer periods fall into scales [Q, 1.5 Q).  At a scale every position is named by the L = 1.5 Q words that start there.  L is
  not below the period, so inside a run equal names lie whole periods apart.  Of each window of 2 Q - L + 1 names the smallest
  is kept: a run of three periods holds two windows one period apart, whose minima are the same name one period apart, with no
  such name between.  So the pairs of equal kept names that are neighbours give every run at least one seed.
* A seed is extended in both directions by comparing the words themselves; names only propose.

Documents are worked on in blocks, laid out in one row with a different number after each document, which equals nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from shelfstream.llm.ragged import in_blocks
from shelfstream.llm.repeats import mix

LEAST_WORDS = 24
LEAST_PERIODS = 3
SHORTEST = 8  # first period found by minimizers
BLOCK = 2 << 20
RESULT = "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: string>"
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest value of every window, by doubling."""
    size = 1
    while 2 * size <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    return pick(values[: size - width], values[width - size :]) if size < width else values


def _joined(names: np.ndarray, shift: int) -> np.ndarray:
    """Names of each position's content together with that of the position ``shift`` further on."""
    after = np.zeros_like(names)
    after[: len(names) - shift] = names[shift:]
    return mix(names * _LEFT + mix(after + _RIGHT))


def _primes(number: int) -> list[int]:
    found, factor = [], 2
    while factor * factor <= number:
        if number % factor == 0:
            found.append(factor)
            while number % factor == 0:
                number //= factor
        factor += 1
    return found + [number] * (number > 1)


def _smallest(words: np.ndarray, start: int, period: int) -> bool:
    """No divisor of the period is a period too; the stretch has two periods at least."""
    shorter = (period // f for f in _primes(period))
    return not any(np.array_equal(words[start : start + period], words[start + c : start + c + period]) for c in shorter)


def _extended(words: np.ndarray, seed: int, period: int) -> tuple[int, int]:
    """The longest stretch through the seed, or up to it, in which words one period apart are identical."""
    size, step = len(words), 64
    right = seed
    while True:
        stop = min(right + step, size - period)
        odd = np.flatnonzero(words[right:stop] != words[right + period : stop + period])
        if len(odd) or stop >= size - period:
            right = right + int(odd[0]) if len(odd) else max(stop, right)
            break
        right, step = stop, min(2 * step, 1 << 16)
    left, step = seed, 64
    while left > 0:
        first = max(left - step, 0)
        odd = np.flatnonzero(words[first:left] != words[first + period : left + period])
        if len(odd):
            left = first + int(odd[-1]) + 1
            break
        left, step = first, min(2 * step, 1 << 16)
    return left, right + period


def _lag_scans(words: np.ndarray, least_words: int, least_periods: int) -> Iterator[tuple[int, int, int]]:
    for period in range(1, min(SHORTEST, len(words))):
        same = np.flatnonzero(words[period:] == words[:-period])
        if not len(same):
            continue
        first = np.flatnonzero(np.diff(same, prepend=-2) != 1)
        starts = same[first]
        lengths = np.diff(np.append(first, len(same))) + period
        for k in np.flatnonzero(lengths >= max(least_words, least_periods * period)).tolist():
            if _smallest(words, int(starts[k]), period):
                yield int(starts[k]), int(lengths[k]), period


def _at_scales(words: np.ndarray, sizes: np.ndarray, least_words: int, least_periods: int) -> Iterator[tuple[int, int, int]]:
    """Runs of the periods from ``SHORTEST`` on; ``sizes`` are the documents' words, the separators not counted."""
    place = np.arange(len(words))
    names, width = mix(words.astype(np.uint64) + _RIGHT), 1
    own, low = words, SHORTEST
    while True:
        high = -(-3 * low // 2)
        long_enough = sizes >= LEAST_PERIODS * low
        if not long_enough.any():
            return
        if not long_enough.all():  # the others' separators go with them
            stay = np.repeat(long_enough, sizes + 1)
            own, names, place, sizes = own[stay], names[stay], place[stay], sizes[long_enough]
        while 2 * width <= high:
            names, width = _joined(names, width), 2 * width
        scale = _joined(names, high - width) if width < high else names
        window = 2 * low - high + 1
        if len(scale) >= window:
            least = _sliding(scale, window, np.minimum)
            edge = np.zeros(window - 1, np.uint64)
            kept = np.flatnonzero(_sliding(np.concatenate((edge, least, edge)), window, np.maximum) == scale)
            order = kept[np.argsort(scale[kept], kind="stable")]
            lag = np.diff(order)
            seeds = np.flatnonzero((scale[order[1:]] == scale[order[:-1]]) & (lag >= low) & (lag < high))
            seeds = seeds[np.lexsort((order[seeds], lag[seeds]))]
            until, last = 0, 0  # the end and the period of the stretch found last
            for at, period in zip(order[seeds].tolist(), lag[seeds].tolist(), strict=True):
                if period == last and at + period < until:
                    continue
                start, until = _extended(own, at, period)
                last = period
                if until - start >= max(least_words, least_periods * period) and _smallest(own, start, period):
                    yield int(place[start]), until - start, period
        low = high


def runs_of(lists: pa.ListArray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of every list of words, by start, then period."""
    if least_periods < 3:
        raise ValueError("runs of fewer than three periods are not found")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(offsets)
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    coded = lists.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = np.full(len(coded) + len(sizes), -1, np.int64)
    ends = np.cumsum(sizes + 1)
    words[ends - 1] = -1 - np.arange(len(sizes))
    words[np.arange(len(coded)) + np.repeat(np.arange(len(sizes)), sizes)] = coded
    for part in (_lag_scans, _at_scales):
        more = (sizes,) if part is _at_scales else ()
        for start, length, period in part(words, *more, least_words, least_periods):
            doc = int(np.searchsorted(ends, start, side="right"))
            found[doc].append((start - int(ends[doc] - sizes[doc] - 1), length, period))
    return [sorted(rows, key=lambda r: (r[0], r[2])) for rows in found]


def split_words(texts: pa.Array) -> pa.ListArray:
    """The words of every text: runs of anything but ASCII white space."""
    lists = pc.ascii_split_whitespace(texts)
    every = lists.flatten()
    filled = pc.not_equal(every, "")
    before = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))
    offsets = before[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), every.filter(filled))


def periodic_runs(text: Column, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> Column:
    """A struct of the type ``RESULT``: the number of words, all runs by start and period, and the words that stay, joined by one blank.

    A run has ``least_words`` words and ``least_periods`` periods at least; its period is the smallest.  Of each run the first
    period stays; a word that lies behind the first period of any run goes.  Null counts as empty; other columns of the table
    are not looked at, and repeated rows give equal results.  A task holds a block of 2 MB, or one text if that is longer.
    """

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [_block(b, least_words, least_periods) for b in in_blocks(pc.fill_null(batch, ""), BLOCK)]
            yield pa.concat_arrays(parts) if parts else pa.array([], ARROW_RESULT)

    return run(text)


ARROW_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
ARROW_RESULT = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(ARROW_RUN)), ("collapsed", pa.string())])


def _block(texts: pa.Array, least_words: int, least_periods: int) -> pa.StructArray:
    lists = split_words(texts)
    found = runs_of(lists, least_words, least_periods)
    plain = pc.binary_join(lists, " ")
    changed = {}
    for k, runs in enumerate(found):
        if runs:
            own = lists[k].as_py()
            stay = np.ones(len(own), bool)
            for start, length, period in runs:
                stay[start + period : start + length] = False
            changed[k] = " ".join([own[i] for i in np.flatnonzero(stay).tolist()])
    if changed:
        rows = plain.to_pylist()
        for k, kept in changed.items():
            rows[k] = kept
        plain = pa.array(rows, pa.string())
    ends = np.concatenate(([0], np.cumsum([len(r) for r in found])))
    flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
    fields = [pa.array(flat[:, c], pa.int64()) for c in range(3)]
    runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(ARROW_RUN)))
    sizes = pa.array(np.diff(lists.offsets.to_numpy()), pa.int64())
    return pa.StructArray.from_arrays([sizes, runs, plain.cast(pa.string())], fields=list(ARROW_RESULT))
