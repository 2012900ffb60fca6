"""Document fingerprints as threshold-scaled sketches of byte shingles.

A fingerprint keeps every shingle hash below a fixed share of the hash range, so its size follows the text and two
fingerprints can be compared however unequal the texts are: below the threshold both are complete, and the share of one's
hashes that the other holds estimates how much of the one is contained in the other.  A text with fewer than ``LEAST`` hashes
below the threshold keeps its ``LEAST`` smallest ones, or all it has; it is then complete up to the largest kept.  Both rules
are closed under union, so the fingerprint of joined texts follows from theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfstream.llm.ragged import in_blocks
from shelfstream.llm.repeats import mix

SHINGLE = 16  # bytes
SHARE = 64  # one hash of so many is below the threshold
LEAST = 16
THRESHOLD = np.uint64((1 << 64) // SHARE)
TASK_BYTES = 64 << 20
MAX_PARTS = 16_384
_EVEN, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# ---- one sketch -----------------------------------------------------------------
def _hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the shingles at every position of the bytes, those behind the end padded with zeros."""
    padded = np.concatenate((data, np.zeros(SHINGLE, np.uint8)))
    eight = np.ndarray((len(data) + 8,), "<u8", padded, strides=(1,)).copy()
    return mix(mix(eight[8:] + _ODD) + eight[:-8] * _EVEN)


def _short(text: bytes) -> np.ndarray:
    """The one hash of a text shorter than a shingle; its length keeps it apart from zeros in the text."""
    if not text:
        return np.empty(0, np.uint64)
    return mix(_hashes(np.frombuffer(text, np.uint8))[:1] + np.uint64(len(text)))


def sketch_many(texts: pa.Array) -> list[np.ndarray]:
    """The sketch of every text: ascending distinct hashes.  Null counts as empty, and an empty text has none."""
    out: list[np.ndarray] = []
    for block in in_blocks(texts.fill_null("")):
        whole = [t.encode("utf-8", "surrogatepass") for t in block.to_pylist()]
        ends = np.cumsum([len(t) for t in whole])
        hashes = _hashes(np.frombuffer(b"".join(whole), np.uint8))
        low = np.flatnonzero(hashes < THRESHOLD)
        cuts = np.searchsorted(low, np.column_stack((ends - [len(t) for t in whole], ends - SHINGLE + 1)))
        for text, end, (first, last) in zip(whole, ends.tolist(), cuts.tolist(), strict=True):
            if len(text) < SHINGLE:
                out.append(_short(text))
                continue
            own = np.unique(hashes[low[first:last]])
            if len(own) < LEAST:
                own = np.unique(hashes[end - len(text) : end - SHINGLE + 1])[:LEAST]
            out.append(own)
    return out


def complete_below(sketch: np.ndarray) -> int:
    """Every shingle hash of the text below this value is in the sketch."""
    if len(sketch) < LEAST:
        return 1 << 64
    return int(THRESHOLD) if len(sketch) > LEAST or sketch[-1] < THRESHOLD else int(sketch[-1]) + 1


def _common(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Hashes of a, of b and of both, where both sketches are complete."""
    last = np.uint64(min(complete_below(a), complete_below(b)) - 1)
    a, b = a[: np.searchsorted(a, last, "right")], b[: np.searchsorted(b, last, "right")]
    return len(a), len(b), int(np.isin(a, b, assume_unique=True).sum())


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated share of a's shingles that b holds.

    Equal sketches give 1, those of two empty texts included; if a has no hash where both are complete, there is no sign
    of anything in common and the result is 0.
    """
    if len(a) == len(b) and bool((a == b).all()):
        return 1.0
    size, _, both = _common(a, b)
    return both / size if size else 0.0


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated Jaccard similarity of the shingle sets, with the same rule for equal sketches and none in common."""
    if len(a) == len(b) and bool((a == b).all()):
        return 1.0
    one, other, both = _common(a, b)
    return both / (one + other - both) if both else 0.0


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    every = np.union1d(a, b)
    return every[: max(LEAST, int(np.searchsorted(every, THRESHOLD)))]


def to_text(sketch: np.ndarray) -> str:
    """16 lowercase hex digits a hash, ascending."""
    return sketch.astype(">u8").tobytes().hex()


def from_text(fingerprint: str | None) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint or ""), ">u8").astype(np.uint64)


# ---- columns ----------------------------------------------------------------------
def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column as a string; null counts as empty, and an empty text gives ''."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([to_text(s) for s in sketch_many(pa.array(batch, pa.large_string()))], dtype="object")

    return run(text)


def contained(a: Column, b: Column) -> Column:
    """:func:`containment` of two fingerprint columns; null counts as the fingerprint of an empty text."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            yield pd.Series([containment(from_text(x), from_text(y)) for x, y in zip(left, right, strict=True)], dtype="float64")

    return run(a, b)


def group_hashes(prints: DataFrame, by: str, fingerprint: str = "fingerprint") -> DataFrame:
    """(``by``, hash, n): the sketch of every group's texts together as rows, with the texts that hold the hash.

    Only hashes below the threshold, which all fingerprints hold completely: so a group of any size is rows of any task,
    counted before the shuffle.  The containment of one group in another is the share of its rows that the other has too.
    """
    parts = F.transform(
        F.sequence(F.lit(0), F.greatest(F.length(fingerprint) / 16 - 1, F.lit(0)).cast("int")),
        lambda k: F.substring(F.col(fingerprint), k * 16 + 1, F.lit(16)),
    )
    rows = prints.select(by, F.explode(parts).alias("hash")).filter(F.col("hash") != "")
    below = F.lit(f"{int(THRESHOLD):016x}")
    return rows.filter(F.col("hash") < below).groupBy(by, "hash").agg(F.count(F.lit(1)).alias("n"))


# ---- documents in a row -------------------------------------------------------------
def _in_order(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(part, follows, key, doc_id, text): rows dealt to parts of the descending order of ids, and each part closed by a copy
    of the row after its last one, marked by ``follows``; after the last row of all comes the first.

    Null ids come last; rows of one id go by a hash of their text.  A part starts at a row of a sample, so only the keys of
    that sample are known to the driver: about 20 for each of at most ``MAX_PARTS`` parts.
    """
    spark = docs.sparkSession
    sign = F.lit(-(1 << 63)).cast("long")
    own = F.col(doc_id).cast("long")
    key = F.concat(
        F.when(own.isNull(), F.lit("0")).otherwise(F.lit("1")),
        F.lpad(F.hex(F.coalesce(own, F.lit(0).cast("long")).bitwiseXOR(sign)), 16, "0"),
        F.lpad(F.hex(F.xxhash64(F.coalesce(F.col(text), F.lit("")))), 16, "0"),
    )
    rows = docs.select(key.alias("key"), own.alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    first, count, size = rows.agg(F.max("key"), F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // TASK_BYTES))
    parts = min(4 * tasks, MAX_PARTS, max(1, (count or 1) // 4))
    sample = rows.select("key").sample(min(1.0, 20 * parts / max(count or 1, 1)), seed=1).distinct().collect()
    known = sorted(r["key"] for r in sample)
    starts = sorted({first or "", *known[len(known) % 20 :: max(1, len(known) // parts)]}, reverse=True)
    ascending = np.array([s.encode() for s in reversed(starts)], "S33")

    @F.pandas_udf("array<int>")
    def deal(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        last = len(ascending) - 1
        for batch in batches:
            keys = np.array([k.encode() for k in batch], "S33")
            at = np.searchsorted(ascending, keys)  # the least start not below the key; starts are counted from the greatest
            own, is_start = last - at, ascending[at] == keys
            # The row that starts a part also closes the part before, as -1 - part.
            yield pd.Series([[p, -1 - ((p - 1) % (last + 1))] if s else [p] for p, s in zip(own.tolist(), is_start.tolist(), strict=True)])

    dealt = rows.withColumn("target", F.explode(deal("key"))).select(
        F.when(F.col("target") < 0, -1 - F.col("target")).otherwise(F.col("target")).alias("part"), (F.col("target") < 0).alias("follows"),
        "key", "doc_id", "text",
    )
    return dealt.repartition(tasks, "part").sortWithinPartitions("part", "follows", F.col("key").desc())


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double, alike_edited double, alike_next double"
)


def compare_in_order(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows of the schema ``RESULT``: every document against an edited form of itself and against the next document.

    Documents follow each other by descending id, null ids last, and the first one comes after the last; rows of one id
    follow each other by a hash of their text, and repeated rows are each other's next.  The edited text is the document
    with its last third (floor of its code points) replaced by as many of the first code points of the next, or by all it
    has.  ``near_*`` is the containment of the document's fingerprint in the other one, ``alike_*`` the Jaccard similarity.
    Null texts count as empty, other columns are ignored, and texts are streamed: a task holds one batch and one row.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        held: tuple | None = None  # the last row so far: part, follows, id, text, sketch
        for batch in batches:
            texts = batch.column("text")
            own = list(zip(
                batch.column("part").to_pylist(), batch.column("follows").to_pylist(), batch.column("doc_id").to_pylist(),
                texts.to_pylist(), sketch_many(texts), strict=True,
            ))
            row = own if held is None else [held, *own]
            held = row[-1] if row else None
            pairs = [(x, y) for x, y in zip(row, row[1:]) if not x[1]]
            edited = [x[3][: len(x[3]) - len(x[3]) // 3] + y[3][: len(x[3]) // 3] for x, y in pairs]
            changed = sketch_many(pa.array(edited, pa.large_string()))
            yield pa.RecordBatch.from_pydict({
                "doc_id": [x[2] for x, _ in pairs],
                "n_chars": [len(x[3]) for x, _ in pairs],
                "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
                "fingerprint": [to_text(x[4]) for x, _ in pairs],
                "edited_fingerprint": [to_text(s) for s in changed],
                "near_edited": [containment(x[4], s) for (x, _), s in zip(pairs, changed, strict=True)],
                "near_next": [containment(x[4], y[4]) for x, y in pairs],
                "alike_edited": [resemblance(x[4], s) for (x, _), s in zip(pairs, changed, strict=True)],
                "alike_next": [resemblance(x[4], y[4]) for x, y in pairs],
            }, schema=ARROW_RESULT)

    return _in_order(docs, text, doc_id).mapInArrow(compare, RESULT)


ARROW_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("alike_edited", pa.float64()),
    ("alike_next", pa.float64()),
])
