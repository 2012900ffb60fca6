"""Suffix-array dedup: the difference-cover algorithm, cut off at the depth that decides.

Only suffixes that agree in their first ``length`` bytes matter, so ordering them to that depth is enough, and any order
that brings equal prefixes together will do: suffixes are ordered by 64-bit names of their prefixes.

1. Sort sampled tuples.  Sampled are the positions whose residue modulo v lies in a difference cover; each gets the name of
   its v bytes.
2. Recurse on names.  The name of a sampled suffix to depth 2v is made of the names at p and p + v, both sampled; one sort
   of these names finds the sampled suffixes that have an equal neighbour.  For any two equal prefixes there is a shift
   below v that brings both to sampled positions, and at least length - v + 1 >= 2v bytes of the match lie behind it.
3. Merge the remaining suffixes.  A suffix without such a neighbour within its next v positions stands alone; all others
   are named by their first ``length`` bytes and sorted.
4. Compare adjacent prefixes: equal neighbours are repeats, and the union of their windows is removed.

Names of different windows agree with a chance of 2**-64 for each pair compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F

from shelfstream.llm.repeats import (
    ARROW_PACK, PACK_SCHEMA, Pack, answered, byte_keys, covered_runs, difference_cover, discard, mix, read_answers, rows_of, write_packs,
)
from shelfstream.session import fresh_path

LENGTH = 400
REST_FIELDS = "clean_docs array<long>, clean_lengths array<long>, clean_sha256 array<string>, region array<struct<a: long, b: long>>"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, text_sha256 string"


def _cover(length: int) -> tuple[int, tuple[int, ...]]:
    """The longest period of which two tuples fit behind the shift."""
    fitting = [q for q in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31) if 3 * (q * q + q + 1) <= length + 1]
    if not fitting:
        raise ValueError("windows of fewer than 20 bytes are not supported")
    return difference_cover(fitting[-1])


def _sampled(pack: Pack, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled positions whose 2v bytes lie in one document, with their names."""
    v, residues = _cover(length)
    size = len(pack.data)
    at = np.sort((np.arange(0, size, v)[:, None] + np.array(residues)).ravel())
    at = at[at < size]
    end = pack.ends[np.searchsorted(pack.ends, at, side="right")] if len(at) else at
    at = at[at + 2 * v <= end]
    tuples = np.unique(np.concatenate((at, at + v)))
    names = byte_keys(pack.data, tuples, v)
    where = np.searchsorted(tuples, at)
    return at, mix(names[where] * np.uint64(3) + names[np.searchsorted(tuples, at + v)])


def _all_suffixes(pack: Pack, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts of the pack's region, and their names."""
    size = len(pack.data)
    step = np.zeros(size + 1, np.int32)
    for run in pack.row["region"]:
        step[run["a"]] += 1
        step[run["b"]] -= 1
    at = np.flatnonzero(np.cumsum(step[:-1]) > 0)
    return at, byte_keys(pack.data, at, length)


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(untouched, cut): rows of the schema ``RESULT``; ``kept`` holds the remaining text of cut documents only,
    without characters that were cut in two; ``text_sha256`` is of the whole input text, for finding rows whose id is not unique.

    Removed is every byte covered by a ``length``-byte string that also starts anywhere else in the corpus, the same
    document included and overlaps counting.  Texts count as UTF-8 bytes, null as empty; no match spans documents.  Each
    input row gives one row, whether ids repeat or are null; other columns are ignored.
    """
    spark = docs.sparkSession
    v, residues = _cover(length)
    packs, size, packed = write_packs(docs, text, doc_id)
    samples = size * len(residues) // v

    def sampled_names(row: dict) -> tuple[np.ndarray, None]:
        return np.unique(_sampled(Pack(row), length)[1]), None

    def region(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            pack = Pack(row)
            at, names = _sampled(pack, length)
            keys, index, counts = np.unique(names, return_inverse=True, return_counts=True)
            shared = at[((counts > 1) | read_answers(row, keys, samples))[index]]
            owner = np.searchsorted(pack.ends, shared, side="right")
            first = np.maximum(pack.starts[owner], shared - v + 1)
            last = np.minimum(pack.ends[owner] - length, shared) + 1
            fits = first < last
            owner, first, last = owner[fits], first[fits], last[fits]
            clean = np.setdiff1d(np.arange(len(pack.docs)), owner)
            kept = np.unique(owner)
            moved = np.concatenate(([0], np.cumsum(pack.lengths[kept])))[:-1]
            shift = (moved - pack.starts[kept])[np.searchsorted(kept, owner)]
            first, last = first + shift, last + shift
            # Overlapping stretches of one document become one.
            order = np.argsort(first, kind="stable")
            first, last = first[order], np.maximum.accumulate(last[order]) if len(last) else last
            new = np.flatnonzero(np.concatenate(([True], first[1:] > last[:-1]))) if len(first) else first
            runs = zip(first[new].tolist(), last[np.append(new[1:], len(last)) - 1].tolist(), strict=True) if len(first) else []
            data = memoryview(row["data"] or b"")
            part = [bytes(data[pack.starts[k] : pack.ends[k]]) for k in range(len(pack.docs))]
            yield pa.RecordBatch.from_pylist([{
                "pack": row["pack"], "docs": [pack.docs[k] for k in kept], "lengths": pack.lengths[kept].tolist(),
                "data": b"".join(part[k] for k in kept),
                "clean_docs": [pack.docs[k] for k in clean], "clean_lengths": pack.lengths[clean].tolist(),
                "clean_sha256": [hashlib.sha256(part[k]).hexdigest() for k in clean],
                "region": [{"a": a, "b": b} for a, b in runs],
            }], schema=arrow_region)

    arrow_region = pa.schema([
        *ARROW_PACK, ("clean_docs", pa.list_(pa.int64())), ("clean_lengths", pa.list_(pa.int64())), ("clean_sha256", pa.list_(pa.string())),
        ("region", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
    ])
    seen, path = Observation(), fresh_path(spark, "regions")
    windows = F.aggregate("region", F.lit(0).cast("long"), lambda total, run: total + run["b"] - run["a"])
    (
        answered(packs, sampled_names, samples)
        .mapInArrow(region, f"{PACK_SCHEMA}, {REST_FIELDS}")
        .observe(seen, F.sum(windows).alias("windows"))
        .write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    )
    discard(spark, packed)
    found = spark.read.parquet(path)
    suffixes = seen.get["windows"] or 0

    def suffix_names(row: dict) -> tuple[np.ndarray, None]:
        return np.unique(_all_suffixes(Pack(row), length)[1]), None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            pack = Pack(row)
            at, names = _all_suffixes(pack, length)
            keys, index, counts = np.unique(names, return_inverse=True, return_counts=True)
            repeated = at[((counts > 1) | read_answers(row, keys, suffixes))[index]]
            owner = np.searchsorted(pack.ends, repeated, side="right")
            data = memoryview(row["data"] or b"")
            out = []
            for k, key in enumerate(pack.docs):
                low, high = np.searchsorted(owner, [k, k + 1])
                first, last = covered_runs(repeated[low:high], length)
                edges = [pack.starts[k], *np.column_stack((first, last)).ravel().tolist(), pack.ends[k]]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                whole = int(pack.lengths[k])
                out.append({
                    "doc_id": key, "n_bytes": whole, "n_removed": whole - len(kept), "n_spans": len(first),
                    "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept.decode("utf-8", "ignore"),
                    "text_sha256": hashlib.sha256(data[pack.starts[k] : pack.ends[k]]).hexdigest(),
                })
            yield pa.RecordBatch.from_pylist(out, schema=arrow_result)

    arrow_result = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()), ("kept", pa.string()), ("text_sha256", pa.string()),
    ])
    touched = found.filter(F.size("docs") > 0).select("pack", "docs", "lengths", "data", "region")
    removed = answered(touched, suffix_names, suffixes).mapInArrow(cut, RESULT)
    untouched = found.select(F.explode(F.arrays_zip("clean_docs", "clean_lengths", "clean_sha256")).alias("c")).select(
        F.col("c.clean_docs").alias("doc_id"), F.col("c.clean_lengths").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("c.clean_sha256").alias("kept_sha256"), F.lit(None).cast("string").alias("kept"),
        F.col("c.clean_sha256").alias("text_sha256"),
    )
    return untouched, removed
