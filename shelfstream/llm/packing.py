"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces are placed from the longest to the shortest, each into the open bin with the least room that still holds it.  If none
does, a bin is opened.  A sequence of length c costs c * (1 + c / QUADRATIC): a linear part and the part of attention.
Opening sizes are judged jointly: each permitted length is tried as the least size to open, every bin is finally downsized
to the cheapest length that holds its contents, and the plan of least total cost is kept.

Pieces are dealt to shards of bounded size by a hash, rows that repeat an id and a length included, and each shard is packed by one task; a shard loses at most one badly
filled bin of each size against packing all at once.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

CAPACITIES = (2048, 4096, 8192, 16384, 32768)
QUADRATIC = 65536
SHARD_PIECES = 20_000
SCHEMA = "doc_id long, piece long, piece_start long, n_tokens long, shard long, bin long, capacity long, bin_start long"


def cost(capacity: int, quadratic: float = QUADRATIC) -> float:
    return capacity * (1 + capacity / quadratic)


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, start in bin, capacity of the bin) of every piece; lengths are given in falling order."""
    sizes = sorted(capacities)
    best: tuple | None = None
    for least in sizes:
        room: list[tuple[int, int]] = []  # (room left, bin), ascending
        filled: list[int] = []
        bins, starts = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for k, length in enumerate(lengths.tolist()):
            at = bisect_left(room, (length, -1))
            if at < len(room):
                left, chosen = room.pop(at)
            else:
                chosen = len(filled)
                left = min((c for c in sizes if c >= max(least, length)), key=cost)
                filled.append(0)
            bins[k], starts[k] = chosen, filled[chosen]
            filled[chosen] += length
            if left > length:
                insort(room, (left - length, chosen))
        final = np.array([min((c for c in sizes if c >= f), key=cost) for f in filled], np.int64)
        total = sum(map(cost, final.tolist()))
        if best is None or total < best[0]:
            best = total, bins, starts, final
    _, bins, starts, final = best
    return bins, starts, final[bins] if len(bins) else bins


def pack_documents(lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Rows of ``SCHEMA`` from (doc_id, n_tokens): every token of every document lies in exactly one bin.

    A document longer than the largest capacity is cut into pieces of that length and a rest.  Rows with a null or
    non-positive length take no room and give no piece; a null id is packed like any other, and repeated rows are packed
    separately.  Bins are numbered within their shard.
    """
    largest = max(capacities)
    pieces = (
        lengths.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("n_tokens").cast("long").alias("whole")).filter("whole > 0")
        .withColumn("salt", F.monotonically_increasing_id())  # deals repeated rows to all shards
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("whole") - 1) / largest).cast("long"))))
        .withColumn("piece_start", F.col("piece") * largest)
        .withColumn("n_tokens", F.least(F.lit(largest).cast("long"), F.col("whole") - F.col("piece_start")))
    )
    shards = max(1, -(-(pieces.agg(F.count(F.lit(1))).first()[0]) // shard_pieces))

    def pack_shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        rows["bin"], rows["bin_start"], rows["capacity"] = pack(rows["n_tokens"].to_numpy(), capacities)
        return rows[["doc_id", "piece", "piece_start", "n_tokens", "shard", "bin", "capacity", "bin_start"]]

    dealt = pieces.select(
        "doc_id", "piece", "piece_start", "n_tokens", F.pmod(F.xxhash64("doc_id", "piece", "whole", "salt"), F.lit(shards)).cast("long").alias("shard")
    )
    return dealt.groupBy("shard").applyInPandas(pack_shard, SCHEMA)


def byte_lengths(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens) for byte-level ids: the text's UTF-8 bytes and an end id; null counts as empty."""
    return docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long").alias("n_tokens"))
