"""Exact dedup by distributed MSD radix partitioning.

The radix string of a document is its normalised length followed by its normalised bytes.  Round by round, documents that
still share a class are split by their next block of bytes; a document leaves as soon as its class holds nobody else or
its bytes have ended.  Blocks are compared as they are, so equality needs no digest.  The first block is short and settles
nearly every document; later blocks grow, so a text of b bytes takes O(log b) rounds, each byte being compared once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from shelfstream.session import fresh_path, materialize

FIRST_BLOCK = 64
GROWTH = 16
LARGEST_BLOCK = 1 << 20


def normalised(text: Column) -> Column:
    """The text with every run of ASCII white space replaced by one blank; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def exact_dedup(docs: DataFrame, carry: list[str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``carry`` columns of every row with keep_id, group_size, kept and text_sha256.

    Of equal texts the row with the smallest id stays (of repeated rows with that id, all are marked as kept).  Null
    texts equal empty ones; a null id is larger than any other, and keep_id is null where a class has null ids only.
    Every input row gives one output row; columns besides ``carry``, the text and the id are ignored.
    """
    spark = docs.sparkSession
    others = [c for c in dict.fromkeys(carry) if c != text]
    state = docs.select(
        F.struct(F.lit(True).alias("_"), *[F.col(c) for c in others]).alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("raw"),
    ).withColumn("class", F.octet_length(normalised(F.col("raw"))).cast("long"))
    finished, offset, width = [], 0, FIRST_BLOCK
    while True:
        split = (
            state.withColumn("norm", normalised(F.col("raw")).cast("binary"))
            .withColumn("block", F.substring("norm", offset + 1, width))
            .withColumn("ended", F.octet_length("norm") <= offset + width)
        )
        # Counted before the shuffle, so a class with a third of all rows travels as one row per task.
        shared = materialize(
            split.groupBy("class", "block").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("size"))
            .filter("size > 1").withColumn("next", F.monotonically_increasing_id()),
            "radix-classes",
        )
        # Shuffled at every size: the classes grow with the corpus.
        joined = split.withColumn("sha", F.sha2("norm", 256)).drop("norm").join(shared.hint("merge"), ["class", "block"], "left")
        done = F.col("size").isNull() | F.col("ended")
        left = Observation()
        path = fresh_path(spark, "radix-round")
        (
            joined.select(
                "row", "id", F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep"),
                F.coalesce("size", F.lit(1)).cast("long").alias("size"), "sha", F.when(~done, F.col("next")).alias("class"),
                (F.col("raw") if text in carry else F.when(~done, F.col("raw"))).alias("raw"),
            )
            .observe(left, F.count("class").alias("rows"))
            .write.parquet(path)
        )
        table = spark.read.parquet(path)
        finished.append(table.filter(F.col("class").isNull()).select("row", "id", "raw", "keep", "size", "sha"))
        if not left.get["rows"]:
            break
        state = table.filter(F.col("class").isNotNull()).select("row", "id", "raw", "class")
        offset, width = offset + width, min(width * GROWTH, LARGEST_BLOCK)
    result = finished[0]
    for part in finished[1:]:
        result = result.unionByName(part)
    return result.select(
        *[F.col("raw").alias(c) if c == text else F.col("row")[c].alias(c) for c in dict.fromkeys(carry)], F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"), F.col("id").eqNullSafe(F.col("keep")).alias("kept"), F.col("sha").alias("text_sha256"),
    )
