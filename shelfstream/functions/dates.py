"""Date parts used by reports and extracts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def yyyymmdd(value: Column) -> Column:
    return F.date_format(value, "yyyyMMdd")


def format_mmddyyyy(value: Column) -> Column:
    return F.date_format(value, "MM/dd/yyyy")


def hour_trunc(value: Column) -> Column:
    """Start of the hour, worked out without the session time zone."""
    return F.to_date(value).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(value))


def epoch_seconds(value: Column) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp."""
    days = F.datediff(F.to_date(value), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)


def from_epoch_seconds(seconds: Column) -> Column:
    days = F.floor(seconds / 86400).cast("int")
    rest = F.pmod(seconds, F.lit(86400)).cast("decimal(18,6)")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), rest
    )


DATE_PARTS = {
    "date": lambda value: F.to_date(value),
    "month_trunc": lambda value: F.trunc(F.to_date(value), "month"),
    "year_trunc": lambda value: F.trunc(F.to_date(value), "year"),
    "hour_trunc": hour_trunc,
    "hod": lambda value: F.hour(value),
    "day_name": lambda value: F.date_format(value, "EEEE"),
}


def date_part(name: str, value: Column) -> Column:
    return DATE_PARTS[name](value)
