"""Finding repeated windows in a corpus: difference covers, packs of documents and a one-bit exchange of window names.

Documents are laid out in packs of a few megabytes.  A task that names windows of a pack (64-bit keys of their content)
sends the distinct names, sorted and cut by key range, to the tasks that own the ranges.  Those sort all names of a range,
compare neighbours and answer with one bit per name; the pack's task names its windows again and reads the bits in the same
order.  A name crosses the network once per pack, as a gap of about six bytes, however often it occurs there; no text is
shuffled with it and no pair of documents is ever formed.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from shelfstream.session import fresh_path

PACK_BYTES = 4 << 20
RANGE_KEYS = 1 << 21  # names that one task sorts at a time, about
ROW_GROUP_BYTES = 8 << 20  # compressed bytes of packs that a Parquet writer holds, and about what a reader decodes at a time
READ_ROWS = 256  # documents taken out of an Arrow batch at a time
HASH_BLOCK = 1 << 16
#: Parquet's vectored reads take a column chunk as one buffer, and each reading thread keeps another of its size off the heap.
READ_IN_PIECES = {"parquet.hadoop.vectored.io.enabled": "false"}
PACK_SCHEMA = "pack long, docs array<long>, lengths array<long>, data binary"
ARROW_PACK = pa.schema([("pack", pa.int64()), ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("data", pa.large_binary())])
_KEY, _LEFT, _RIGHT = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@cache
def difference_cover(q: int) -> tuple[int, tuple[int, ...]]:
    """For a prime q: the period v = q*q+q+1 and q+1 residues of which every difference modulo v occurs (Singer).

    The residues are the zeros of a third-order linear recurrence over the integers modulo q; the first recurrence whose
    zeros have the property is taken.
    """
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                state, zeros = (0, 0, 1), []
                for n in range(v):
                    if state[0] == 0:
                        zeros.append(n)
                    state = (state[1], state[2], (a * state[2] + b * state[1] + c * state[0]) % q)
                if len(zeros) == q + 1 and len({(x - y) % v for x in zeros for y in zeros}) == v:
                    return v, tuple(zeros)
    raise ValueError(f"no cover for {q}")


# ---- content keys -----------------------------------------------------------
def mix(keys: np.ndarray) -> np.ndarray:
    """Spread the keys' bits over all 64, one to one."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of pairs of names.  Names go through :func:`mix` at every step, so no sum of them can be steered."""
    return mix(left * _LEFT + right * _RIGHT)


def window_names(names: np.ndarray, width: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Names of the windows of ``length`` units at ``starts``, from the names of ``width`` units at every position."""
    while 2 * width <= length:
        names, width = joined(names[:-width], names[width:]), 2 * width
    return joined(names[starts], names[starts + length - width]) if width < length else names[starts]


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every position as one number, zeros behind the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data),), "<u8", padded, strides=(1,)).copy()


def byte_keys(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Keys of windows of bytes at ascending starts; works in blocks, so memory stays bounded for long texts."""
    out = np.empty(len(starts), np.uint64)
    mask = np.uint64((1 << 8 * min(length, 8)) - 1)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        stop = int(np.searchsorted(starts, first + HASH_BLOCK))
        block = eight_bytes(data[first : int(starts[stop - 1]) + length])
        out[at:stop] = window_names(mix((block & mask) + _KEY), min(length, 8), starts[at:stop] - first, length)
        at = stop
    return out


def word_keys(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Keys of the words [first, last), ascending, eight bytes at a time; works in blocks like :func:`byte_keys`."""
    out = np.empty(len(first), np.uint64)
    at = 0
    while at < len(first):
        start = int(first[at])
        limit = last.dtype.type(min(start + 8 * HASH_BLOCK, int(last[-1])))  # of the array's type, else it is copied
        stop = max(at + 1, int(np.searchsorted(last, limit, side="right")))
        out[at:stop] = _word_keys(data[start : int(last[stop - 1])], first[at:stop] - start, last[at:stop] - start)
        at = stop
    return out


def _word_keys(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    eight = np.ndarray((len(data),), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    keys = mix((last - first).astype(np.uint64) + _KEY)
    at, going = first.copy(), np.arange(len(first))
    while len(going):
        left = last[going] - at[going]
        mask = np.uint64((1 << 64) - 1) >> (np.uint64(64) - np.uint64(8) * np.minimum(left, 8).astype(np.uint64))
        keys[going] = joined(keys[going], mix(eight[at[going]] & mask))
        at[going] += 8
        going = going[left > 8]
    return keys


# ---- packs --------------------------------------------------------------------
def free_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished jobs.

    It removes a shuffle's files when its plan is garbage, which on an idle driver may be half an hour later.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a working table that nothing reads any more, with the shuffle files of the jobs before it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    free_shuffles(spark)


def write_large_rows(df: DataFrame, path: str) -> None:
    """Write rows of megabytes in row groups of about ``ROW_GROUP_BYTES``.

    Unless told, a Parquet writer looks at its buffers every 100 rows only: up to that it holds 400 MB of packs in one
    page, and whoever reads the row group gets as much at once.  How many packs a task writes depends on its input.
    """
    every_row = {f"parquet.{kind}.size.row.check.{limit}": 1 for kind in ("page", "block") for limit in ("min", "max")}
    df.write.options(compression="zstd", **{"parquet.block.size": ROW_GROUP_BYTES}, **every_row).parquet(path)


def write_packs(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, int, str]:
    """The documents as a table of packs in the shared folder, the bytes of all texts, and the table's path."""
    spark = docs.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def row() -> pa.RecordBatch:
            own = {"pack": part << 32 | number, "docs": ids, "lengths": [len(t) for t in texts], "data": b"".join(texts)}
            return pa.RecordBatch.from_pylist([own], schema=ARROW_PACK)

        for batch in batches:
            for low in range(0, batch.num_rows, READ_ROWS):
                some = batch.slice(low, READ_ROWS)
                for key, data in zip(some.column("doc_id").to_pylist(), some.column("data").to_pylist(), strict=True):
                    if ids and held + len(data) > PACK_BYTES:
                        yield row()
                        ids, texts, held, number = [], [], 0, number + 1
                    ids.append(key)
                    texts.append(data)
                    held += len(data)
                del some
            del batch  # before the next one is read
        if ids:
            yield row()

    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"))
    seen, path = Observation(), fresh_path(spark, "packs")
    write_large_rows(plain.mapInArrow(pack, PACK_SCHEMA).observe(seen, F.sum(F.octet_length("data")).alias("bytes")), path)
    return spark.read.options(**READ_IN_PIECES).parquet(path), seen.get["bytes"] or 0, path


class Pack:
    """One pack's arrays, from a row of the packs table."""

    def __init__(self, row: dict):
        self.row = row
        self.data = np.frombuffer(row["data"] or b"", np.uint8)
        self.docs = row["docs"]
        self.lengths = np.array(row["lengths"], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths


# ---- the exchange ---------------------------------------------------------------
def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each key range ends in the sorted keys."""
    width = (1 << 64) // ranges + 1
    limits = np.array([min(k * width, (1 << 64) - 1) for k in range(1, ranges)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, limits), [len(keys)]))


def _sent(keys: np.ndarray) -> bytes:
    """Ascending keys as gaps: the five low bytes of each as they are, the high ones, mostly zeros, deflated."""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    pack = zlib.compressobj(1, strategy=zlib.Z_RLE)
    high = pack.compress(gaps[:, 5:].T.tobytes()) + pack.flush()
    return len(keys).to_bytes(8, "little") + gaps[:, :5].tobytes() + high


def _size(sent: bytes | pa.Buffer) -> int:
    return int.from_bytes(memoryview(sent)[:8], "little")


def _received(sent: bytes | pa.Buffer) -> np.ndarray:
    size = _size(sent)
    gaps = np.empty((size, 8), np.uint8)
    gaps[:, :5] = np.frombuffer(sent, np.uint8, 5 * size, 8).reshape(-1, 5)
    gaps[:, 5:] = np.frombuffer(zlib.decompress(memoryview(sent)[8 + 5 * size :]), np.uint8).reshape(3, -1).T
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64)


def answered(packs: DataFrame, name: Callable[[dict], tuple[np.ndarray, np.ndarray | None]], keys_in_all: int) -> DataFrame:
    """``packs`` with the column ``answers`` of :func:`answers_of`."""
    return packs.join(answers_of(packs, name, keys_in_all).hint("merge"), "pack", "left")


def answered_map(
    packs: DataFrame, name: Callable[[dict], tuple[np.ndarray, np.ndarray | None]], keys_in_all: int,
    work: Callable[[dict], Iterator[pa.RecordBatch]], schema: pa.Schema, ddl: str,
) -> DataFrame:
    """What ``work`` makes of each pack with its ``answers``.

    Packs come to Python one by one, so that no process holds more than a pack however many share a partition.
    """
    def each(pack: pa.Table, answers: pa.Table) -> pa.Table:
        given = answers.column("answers").to_pylist() or [None]
        made = [batch for row in rows_of(pack.to_batches()) for batch in work(row | {"answers": given[0]})]
        return pa.Table.from_batches(made, schema=schema)

    answers = answers_of(packs, name, keys_in_all)
    return packs.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(each, ddl)


def answers_of(packs: DataFrame, name: Callable[[dict], tuple[np.ndarray, np.ndarray | None]], keys_in_all: int) -> DataFrame:
    """``answers`` of each ``pack``: a list of (range, bits), one bit per distinct name of the pack, names ascending.

    ``name`` gives a pack's distinct sorted names and, or not, a value for each.  The bit says that another pack has the
    name; with values, that some pack has the name with a smaller value.
    """
    ranges = max(1, -(-keys_in_all // RANGE_KEYS))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys, values = name(row)
            cuts = _ranges(keys, ranges)
            every = np.flatnonzero(np.diff(cuts))
            few = max(1, HASH_BLOCK * len(every) // max(1, len(keys)))  # ranges of about HASH_BLOCK names
            for full in (every[low : low + few] for low in range(0, len(every), few)):
                columns = [
                    pa.array(full, pa.int64()), pa.array([row["pack"]] * len(full), pa.int64()),
                    pa.array([_sent(keys[cuts[k] : cuts[k + 1]]) for k in full], pa.binary()),
                    pa.array([b"" if values is None else values[cuts[k] : cuts[k + 1]].astype("<i8").tobytes() for k in full], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["range", "pack", "keys", "values"])

    def compare(table: pa.Table) -> pa.Table:
        sizes = [_size(x.as_buffer()) for x in table.column("keys")]
        ends = np.cumsum(sizes)
        every = np.empty(sum(sizes), np.uint64)
        for x, e, n in zip(table.column("keys"), ends, sizes, strict=True):
            every[e - n : e] = _received(x.as_buffer())
        order = np.argsort(every)
        new = np.ones(len(order) + 1, bool)  # whether another name begins, also behind the last
        for low in range(1, len(order), HASH_BLOCK):
            part = every[order[low - 1 : low + HASH_BLOCK]]
            new[low : low + len(part) - 1] = part[1:] != part[:-1]
        del every
        bits = np.empty(len(order), bool)
        if any(len(x.as_buffer()) for x in table.column("values")):
            own = np.empty(len(order), np.int64)
            for x, e, n in zip(table.column("values"), ends, sizes, strict=True):
                own[e - n : e] = np.frombuffer(x.as_buffer(), "<i8")
            low = 0
            while low < len(order):
                high = min(low + HASH_BLOCK, len(order))
                high += int(np.argmax(new[high:]))
                first, part = np.flatnonzero(new[low:high]), own[order[low:high]]
                bits[order[low:high]] = np.repeat(np.minimum.reduceat(part, first), np.diff(first, append=len(part))) < part
                low = high
        else:
            bits[order] = ~(new[:-1] & new[1:])
        packed = [np.packbits(bits[e - n : e]).tobytes() for e, n in zip(ends, sizes, strict=True)]
        return pa.table({"pack": table.column("pack"), "range": table.column("range"), "bits": pa.array(packed, pa.binary())})

    named = packs.mapInArrow(send, "range long, pack long, keys binary, values binary")
    bits = named.groupBy("range").applyInArrow(compare, "pack long, range long, bits binary")
    lists = bits.groupBy("pack").agg(F.collect_list(F.struct("range", "bits")).alias("answers"))
    path = fresh_path(packs.sparkSession, "answers")
    lists.write.parquet(path)
    return packs.sparkSession.read.parquet(path)


def read_answers(row: dict, keys: np.ndarray, keys_in_all: int) -> np.ndarray:
    """The bits for the pack's distinct sorted names."""
    ranges = max(1, -(-keys_in_all // RANGE_KEYS))
    cuts = _ranges(keys, ranges)
    bits = np.zeros(len(keys), bool)
    for answer in row["answers"] or []:
        a, b = cuts[answer["range"]], cuts[answer["range"] + 1]
        bits[a:b] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=b - a).view(bool)
    return bits


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]
        del batch  # before the next one is read


def covered_runs(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by windows of one length at ascending starts."""
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(starts[1:] > starts[:-1] + length)
    return starts[np.concatenate(([0], gap + 1))], starts[np.concatenate((gap, [len(starts) - 1]))] + length
