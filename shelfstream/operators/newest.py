"""Newest titles of chosen shelving locations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Fixed value: how a feed entry names its record.
FEED_RECORD_ID = r"biblio-record_entry/(\d+)"


def newest_items(
    copy: DataFrame, call_number: DataFrame, locations: Sequence[int], count: int = 10
) -> DataFrame:
    """The ``count`` titles with the newest copy in the locations (a top-k report).

    Copies fold to one date per volume before the join; the top rows come from
    a distributed partial sort.
    """
    volumes = (
        copy.filter(F.col("location").isin(list(locations)) & ~F.col("deleted"))
        .groupBy("call_number").agg(F.max("create_date").alias("newest"))
    )
    titles = call_number.select(F.col("id").alias("call_number"), F.col("record").alias("biblio_id"))
    return (
        volumes.join(titles, "call_number")
        .groupBy("biblio_id").agg(F.max("newest").alias("newest"))
        .orderBy(F.desc("newest"), F.desc("biblio_id"))
        .limit(count)
    )


def record_list(newest: DataFrame) -> DataFrame:
    """``record_list(id,id,…)``, newest first; the input is a bounded top-k."""
    ordered = F.reverse(F.array_sort(F.collect_list(F.struct("newest", "biblio_id"))))
    ids = F.transform(ordered, lambda r: r["biblio_id"].cast("string"))
    return newest.agg(F.concat(F.lit("record_list("), F.array_join(ids, ","), F.lit(")")).alias("record_list"))


def feed_record_ids(feed: DataFrame, column: str) -> DataFrame:
    """Record ids named in each feed document, in document order."""
    ids = F.regexp_extract_all(F.col(column), F.lit(FEED_RECORD_ID), F.lit(1))
    return feed.withColumn("record_ids", F.array_join(ids, ","))
