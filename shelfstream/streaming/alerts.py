"""Structured Streaming versions of the log operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfstream.functions.thresholds import classify
from shelfstream.operators.logs import service_health


def stream_service_health(lines: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Score status lines as they arrive and append them to a parquet table.

    The checkpoint keeps the position in each file; the file sink commits each
    batch once, also after a restart.
    """
    return (
        service_health(lines).writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_window_counts(lines: DataFrame, mark: str, minutes: int, lateness: str, output: str, checkpoint: str) -> StreamingQuery:
    """Keep the counts of marked lines per window; :func:`window_counts` reads them.

    Each batch writes the windows it changed, also those still open, to a folder of its own, which a repeated batch
    replaces.  Lines later than ``lateness`` are not counted.  ``ts`` is an instant (watermarks need one); the query's
    windows follow UTC.
    """
    counts = (
        lines.filter(F.col("line").contains(mark))
        .withWatermark("ts", lateness)
        .groupBy(F.window("ts", f"{minutes} minutes").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "n")
    )

    def record(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{output}/batch={batch}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(record)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def window_counts(spark: SparkSession, output: str, warn: int, crit: int) -> DataFrame:
    """(window_start, n, severity): the latest count of every window, open ones included."""
    changes = spark.read.schema("window_start timestamp, n bigint, batch bigint").parquet(output)
    latest = changes.groupBy("window_start").agg(F.max_by("n", "batch").alias("n"))
    return latest.withColumn("severity", classify(F.col("n"), warn, crit, inclusive=True))


def stream_missing_hours(lines: DataFrame, first_hour: str, lateness_hours: int, output: str, checkpoint: str) -> StreamingQuery:
    """Report the hours in which a source wrote no line, and withdraw them when lines come late.

    ``lines`` has ``source`` and ``ts``, an instant; ``first_hour`` is one too.  An hour is missing as soon as the stream's newest
    line, of whatever source, is in a later hour: a timer on the watermark reports for sources that have fallen silent, once
    they are known by a first line.  Lines up to ``lateness_hours`` behind the newest withdraw a report; later ones are left
    out, as the watermark has it.  Hours follow UTC.  A source's state is one number and its hours within the lateness.
    Each batch writes its changes to a folder of its own, which a repeated batch replaces; :func:`missing_hours` reads them.
    """
    start = int(pd.Timestamp(first_hour).floor("h").tz_localize("UTC").timestamp()) // 3600
    hour_ms = 3_600_000

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        upto, seen, missing = state.get if state.exists else (start, [], [])
        seen, missing, changes = set(seen), set(missing), []
        if not state.hasTimedOut:
            for batch in batches:
                seen.update(batch["hour"].unique().tolist())
        watermark = state.getCurrentWatermarkMs()
        newest = max([*seen, upto, *([watermark // hour_ms + lateness_hours] if watermark > 0 else [])])
        for hour in sorted(missing & seen):
            changes.append((hour, False))
        missing -= seen
        for hour in range(upto, newest):
            if hour not in seen:
                changes.append((hour, True))
                missing.add(hour)
        # What ended before the watermark cannot change any more.
        state.update((newest, sorted(h for h in seen if h >= newest), sorted(h for h in missing if (h + 1) * hour_ms > watermark)))
        state.setTimeoutTimestamp(max(watermark + 1, (newest + 1 - lateness_hours) * hour_ms))
        yield pd.DataFrame({"source": key[0], "hour": [h for h, _ in changes], "missing": [m for _, m in changes]})

    def latest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Only the latest line of each source and hour of a batch goes into the shuffle."""
        for batch in batches:
            yield batch.sort_values("micros", ascending=False).drop_duplicates(["source", "hour"])

    numbers = lines.filter("ts IS NOT NULL").select("source", F.unix_micros("ts").alias("micros"), F.expr("unix_seconds(ts) DIV 3600 AS hour"))
    hours = (
        numbers.mapInPandas(latest, "source string, micros long, hour long")
        .select("source", "hour", F.timestamp_micros("micros").alias("ts")).withWatermark("ts", f"{lateness_hours} hours")
    )
    changes = hours.groupBy("source").applyInPandasWithState(
        follow, "source string, hour long, missing boolean", "upto long, seen array<long>, missing array<long>", "update",
        GroupStateTimeout.EventTimeTimeout,
    )

    def record(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{output}/batch={batch}")

    return (
        changes.writeStream.outputMode("update")
        .foreachBatch(record)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def missing_hours(spark: SparkSession, output: str) -> DataFrame:
    """(source, hour, severity): the hours that are missing by the last word on each."""
    changes = spark.read.schema("source string, hour long, missing boolean, batch bigint").parquet(output)
    latest = changes.groupBy("source", "hour").agg(F.max_by("missing", "batch").alias("missing")).filter("missing")
    return latest.select("source", F.timestamp_seconds(F.col("hour") * 3600).alias("hour"), F.lit(1).alias("severity"))
