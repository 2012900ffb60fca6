"""SimHash near-dedup with a segment-popcount embedding and a grid range-join.

A 64-bit fingerprint is mapped to the bit counts of its 16 four-bit segments.  One flipped bit moves one count by one, so
the Manhattan distance of two such vectors is a lower bound of the Hamming distance.  Vectors within distance two have a
lattice point within one step of both: every distinct fingerprint is filed under its own point and the points one step
away, and fingerprints of a common point are verified by their differing bits.

Points shared by many fingerprints are refined to segments of a single bit.  There the vector is the fingerprint and the
distance is exact, so everything filed under one point is linked to its smallest member, without looking at pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfstream.llm.components import components
from shelfstream.session import materialize, materialize_counted

SHINGLE = 3
SEED = 42
MAX_BITS = 2
CROWDED = 64  # fingerprints of one lattice point; beyond, the point is refined
BLOCK = 1 << 18  # hashes counted at once


def _fingerprint(text: str | None, shingle: int) -> int:
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        hashes = [xxh64_intdigest(joined[s:e], SEED) for s, e in spans]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = np.array(hashes[at : at + BLOCK], dtype="<u8").view(np.uint8)
        ones += np.unpackbits(block.reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprint_column(shingle: int) -> Callable[[Column], Column]:
    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_fingerprint(t, shingle) for t in batch], dtype="int64")

    return fingerprint


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of every row; no words give zero."""
    return docs.select(F.col(doc_id).alias("doc_id"), _fingerprint_column(shingle)(F.col(text)).alias("fp"))


def _points() -> str:
    """SQL: the packed nibble counts ``v`` and every lattice point one step away."""
    up = "transform(filter(sequence(0, 15), j -> (shiftrightunsigned(v, 4 * j) & 15) < 4), j -> v + shiftleft(1L, 4 * j))"
    down = "transform(filter(sequence(0, 15), j -> (shiftrightunsigned(v, 4 * j) & 15) > 0), j -> v - shiftleft(1L, 4 * j))"
    return f"concat(array(v), {up}, {down})"


def links(nodes: DataFrame) -> DataFrame:
    """Edges (node, to) between ids of distinct fingerprints (``fp``, ``id``) that connect exactly what two bits connect."""
    # Counts of bit pairs by bit logic, as sums may not reach the sign bit; 0x5555... and 0x3333... are the field masks.
    filed = (
        nodes.selectExpr("fp", "id", "fp & 6148914691236517205L AS a", "shiftrightunsigned(fp, 1) & 6148914691236517205L AS b")
        .selectExpr("fp", "id", "(a ^ b) | shiftleft(a & b, 1) AS p")
        .selectExpr("fp", "id", "(p & 3689348814741910323L) + (shiftrightunsigned(p, 2) & 3689348814741910323L) AS v")
        .selectExpr("fp", "id", f"explode({_points()}) AS point")
    )
    shared = materialize(filed.groupBy("point").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "points")
    members = materialize(filed.join(shared.hint("merge"), "point"), "members")
    near = (
        members.filter(f"n <= {CROWDED}").groupBy("point").agg(F.collect_list(F.struct("fp", "id")).alias("all"))
        .selectExpr("all", "explode(all) AS a")
        .selectExpr("a.id AS node", f"explode(filter(all, b -> b.id < a.id AND bit_count(b.fp ^ a.fp) <= {MAX_BITS})) AS b")
        .selectExpr("node", "b.id AS to")
    )
    fine = (
        members.filter(f"n > {CROWDED}").select("fp", "id").distinct()
        .selectExpr("id", "explode(concat(array(fp), transform(sequence(0, 63), j -> fp ^ shiftleft(1L, j)))) AS point")
    )
    centres = fine.groupBy("point").agg(F.min("id").alias("to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    stars = fine.join(centres.hint("merge"), "point").filter("id <> to").selectExpr("id AS node", "to")
    return near.union(stars)


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    Fingerprints link at two or fewer differing bits; component_id is the smallest id reachable.  Rows with a null id
    take no part in links and get a null component.  Equal fingerprints (copies, empty texts) are one node.
    """
    prints = materialize(fingerprints(docs, text, doc_id, shingle), "fingerprints")
    nodes = materialize(prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id")), "nodes")
    roots = components(links(nodes))
    named = nodes.join(roots.hint("merge"), nodes["id"] == roots["node"], "left").select("fp", F.coalesce("root", "id").alias("component_id"))
    return prints.join(named.hint("merge"), "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group of linked fingerprints one row stays, whole.

    It is the row with the smallest id, null ids last, then with the smallest SHA-256 of its text; a row that repeats
    under one id and text stays once.  Ids may so repeat or be null: rows are told apart by id and text.  Null texts count
    as empty, and texts without words are one group.
    """
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), digest.alias("sha"))
    prints = materialize(rows.select("doc_id", "sha", _fingerprint_column(shingle)(F.col("text")).alias("fp")), "fingerprints")
    nodes = materialize(prints.select("fp", F.col("fp").alias("id")).distinct(), "nodes")
    roots = components(links(nodes))
    rooted = prints.join(roots.hint("merge"), prints["fp"] == roots["node"], "left").withColumn("group", F.coalesce("root", "fp"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col("sha").alias("kept_sha"))
    kept = rooted.groupBy("group").agg(F.min(order).alias("k"), F.count(F.lit(1)).alias("n"))
    # Only the groups of several rows have anything to drop.
    several = rooted.join(kept.filter("n > 1").hint("merge"), "group").select("doc_id", "sha", "k")
    stays = F.col("doc_id").eqNullSafe(F.col("k.id")) & (F.col("sha") == F.col("k.kept_sha"))
    marks = materialize(several.groupBy("doc_id", "sha").agg(F.first(stays).alias("stays"), F.count(F.lit(1)).alias("times")), "marks")
    dropped = marks.filter("not stays").select(F.col("doc_id").alias("_gone_id"), F.col("sha").alias("_gone_sha"))
    twice = marks.filter("stays AND times > 1").select(F.col("doc_id").alias("_gone_id"), F.col("sha").alias("_gone_sha"))
    twice, repeated = materialize_counted(twice, "repeats")
    own = docs.withColumn("_own_sha", digest)
    same = F.col(doc_id).eqNullSafe(F.col("_gone_id")) & (F.col("_own_sha") == F.col("_gone_sha"))
    left = own.join(dropped.hint("merge"), same, "left_anti")
    if repeated:
        once = left.join(twice.hint("merge"), same, "left_semi").dropDuplicates([doc_id, "_own_sha"])
        left = left.join(twice.hint("merge"), same, "left_anti").unionByName(once)
    return left.drop("_own_sha")
