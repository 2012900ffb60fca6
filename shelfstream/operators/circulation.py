"""Circulation aggregates: one pass over live and archived loans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstream.operators.copies import before_day


def all_circulations(circulation: DataFrame, aged_circulation: DataFrame) -> DataFrame:
    """Live and archived loans; ``is_live`` tells them apart."""
    live = circulation.withColumn("is_live", F.lit(True))
    aged = aged_circulation.withColumn("is_live", F.lit(False))
    return live.unionByName(aged)


def _null_if_zero(count):
    return F.nullif(count, F.lit(0).cast("bigint"))


def circ_stats(
    circulation: DataFrame,
    aged_circulation: DataFrame,
    window_date: str,
    until: str | None,
    copy_ids: DataFrame | None = None,
) -> DataFrame:
    """Loan counts and latest dates per copy, of all copies or of those whose ``id`` is in ``copy_ids``.

    Monthly and annual counts run from ``window_date`` minus one month or year
    without an upper bound; the other columns take loans dated before ``until``
    (``None``: all loans).  A copy with no loan before ``until`` has no row.
    The historical job calls this with ``window_date='1800-01-01'`` and
    ``until=None``, which makes all three counts equal.
    """
    loans = all_circulations(
        *[df.select("id", "target_copy", "xact_start", "due_date", "checkin_time") for df in (circulation, aged_circulation)]
    )
    if copy_ids is not None:
        loans = loans.join(copy_ids.select(F.col("id").alias("target_copy")), "target_copy", "left_semi")
    start = F.col("xact_start")
    day = F.lit(window_date).cast("date")
    # date(xact_start) > D - interval: the first instant that counts is one day later
    since_month = F.to_date(start) > F.add_months(day, -1)
    since_year = F.to_date(start) > F.add_months(day, -12)
    earlier = before_day("xact_start", until)
    return (
        loans.groupBy(F.col("target_copy").alias("ac_id"))
        .agg(
            F.count(F.when(earlier, F.col("id"))).alias("all_circs"),
            _null_if_zero(F.count(F.when(since_month, F.col("id")))).alias("monthly_circs"),
            _null_if_zero(F.count(F.when(since_year, F.col("id")))).alias("annual_circs"),
            F.max(F.when(earlier, F.to_date("checkin_time"))).alias("last_checkin"),
            F.max(F.when(earlier, F.to_date("due_date"))).alias("last_due"),
            F.max(F.when(earlier, F.to_date(start))).alias("last_circ"),
        )
        .filter("all_circs > 0")
    )


def in_items(circ_stats_df: DataFrame, items: DataFrame) -> DataFrame:
    return circ_stats_df.join(items.select("ac_id"), "ac_id", "left_semi")


def items_with_circs(items: DataFrame, stats: DataFrame) -> DataFrame:
    """Every item with its loan statistics, NULL where it never circulated."""
    return items.join(stats, "ac_id", "left")


def last_circ(
    circulation: DataFrame, aged_circulation: DataFrame, org_unit: DataFrame, copy_ids: DataFrame | None = None
) -> DataFrame:
    """Per copy: library of the latest loan, date of the latest live loan, lifetime count.

    Of all copies, or of those whose ``id`` is in ``copy_ids``: other loans leave before they are folded.  Aggregation keeps one row per copy and task, so a copy with a very large
    loan history is never gathered or sorted in one place.
    """
    loans = all_circulations(
        *[df.select("id", "target_copy", "circ_lib", "xact_start") for df in (circulation, aged_circulation)]
    )
    if copy_ids is not None:
        loans = loans.join(copy_ids.select(F.col("id").alias("target_copy")), "target_copy", "left_semi")
    stats = loans.groupBy(F.col("target_copy").alias("ac_id")).agg(
        F.max_by("circ_lib", F.struct("xact_start", "id")).alias("last_lib"),
        F.max(F.when(F.col("is_live"), F.to_date("xact_start"))).alias("last_use"),
        F.count("id").alias("circ_count"),
    )
    units = org_unit.select(F.col("id").alias("last_lib"), F.col("shortname").alias("last_circ_lib"))
    return stats.join(units, "last_lib", "left").select("ac_id", "last_circ_lib", "last_use", "circ_count")


def arrivals(transit_copy: DataFrame, copy: DataFrame) -> DataFrame:
    """Latest receipt per copy of transits to the copy's own library."""
    received = transit_copy.groupBy("target_copy", "dest").agg(F.max("dest_recv_time").alias("arrived"))
    own = copy.select(F.col("id").alias("target_copy"), F.col("circ_lib").alias("dest"))
    return (
        received.join(own, ["target_copy", "dest"])
        .filter("arrived IS NOT NULL")
        .select(F.col("target_copy").alias("ac_id"), "arrived")
    )


def loans_after_arrival(circulation: DataFrame, arrived: DataFrame) -> DataFrame:
    """Live loans that began after the copy's arrival, 0 where there were none.

    The range condition sits on an inner join, where a copy with very many
    loans can be split over tasks; only its count is joined back.
    """
    starts = circulation.select(F.col("target_copy").alias("ac_id"), "xact_start")
    later = (
        starts.join(arrived, "ac_id")
        .filter(F.col("xact_start") > F.col("arrived"))
        .groupBy("ac_id").agg(F.count(F.lit(1)).alias("n"))
    )
    return arrived.join(later, "ac_id", "left").select(
        "ac_id", "arrived", F.coalesce("n", F.lit(0)).cast("bigint").alias("uses_since_arrival")
    )
