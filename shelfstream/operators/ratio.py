"""Active holds against holdable copies per title."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def hold_copy_ratio(
    hold_request: DataFrame,
    hold_request_record: DataFrame,
    copy: DataFrame,
    copy_location: DataFrame,
    copy_status: DataFrame,
    call_number: DataFrame,
    record_entry: DataFrame,
) -> DataFrame:
    """(id, copy_count, hold_count, hold_copy_ratio) for titles with active holds.

    A title without holdable copies is divided by 0.1.
    """
    titles = hold_request_record.groupBy("id").agg(F.min("bib_record").alias("bib"))
    holds = (
        hold_request.filter(F.col("cancel_time").isNull() & F.col("fulfillment_time").isNull())
        .select("id")
        .join(titles, "id", "left")
        .groupBy(F.col("bib").alias("id"))
        .agg(F.count(F.lit(1)).alias("hold_count"))
    )
    places = copy_location.filter("holdable").select(F.col("id").alias("location"))
    states = copy_status.filter("holdable").select(F.col("id").alias("status"))
    per_volume = (
        copy.filter(F.col("holdable") & ~F.col("deleted"))
        .join(places, "location", "left_semi")
        .join(states, "status", "left_semi")
        .groupBy("call_number")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    volumes = call_number.select(F.col("id").alias("call_number"), F.col("record").alias("bib"))
    copies = (
        per_volume.join(volumes, "call_number")
        .groupBy("bib").agg(F.sum("n").alias("copy_count"))
        .join(record_entry.select(F.col("id").alias("bib")), "bib", "left_semi")
    )
    divisor = F.when(F.col("copy_count").isNull() | (F.col("copy_count") == 0), F.lit(0.1)).otherwise(
        F.col("copy_count").cast("double")
    )
    return holds.join(copies, holds["id"] == copies["bib"], "left").select(
        "id",
        F.coalesce("copy_count", F.lit(0)).cast("bigint").alias("copy_count"),
        "hold_count",
        (F.col("hold_count").cast("double") / divisor).alias("hold_copy_ratio"),
    )
