"""Daily and all-time transaction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfstream.operators.copies import status_label

COLUMNS = (
    "root", "ac_id", "barcode", "biblio_id", "transaction_type", "transaction_date", "transaction_branch", "due_date",
)


def previous_day(column: str, as_of: str | None, strict_reference: bool = False) -> Column:
    """Open interval (day - 1, day): both midnights are outside.

    ``None`` takes all times; ``strict_reference`` then takes events without a time as well, such as the return of an open loan.
    """
    if as_of is None:
        return F.lit(True) if strict_reference else F.col(column).isNotNull()
    day = F.lit(as_of).cast("date")
    return (F.col(column) > F.date_sub(day, 1).cast("timestamp_ntz")) & (
        F.col(column) < day.cast("timestamp_ntz")
    )


def loan_events(circulation: DataFrame, as_of: str | None, strict_reference: bool = False) -> DataFrame:
    """Check-outs (or renewals) and check-ins as rows keyed by copy."""
    out = circulation.filter(previous_day("xact_start", as_of, strict_reference)).select(
        F.col("target_copy").alias("ac_id"),
        F.col("circ_lib").alias("branch_id"),
        F.when(F.col("parent_circ").isNotNull(), "renewal").otherwise("circ").alias("transaction_type"),
        F.col("xact_start").alias("transaction_date"),
        "due_date",
    )
    back = circulation.filter(previous_day("checkin_time", as_of, strict_reference)).select(
        F.col("target_copy").alias("ac_id"),
        F.col("circ_lib").alias("branch_id"),
        F.lit("checkin").alias("transaction_type"),
        F.col("checkin_time").alias("transaction_date"),
        F.lit(None).cast("timestamp_ntz").alias("due_date"),
    )
    return out.unionByName(back)


def copy_events(copies: DataFrame, as_of: str | None, strict_reference: bool = False) -> DataFrame:
    """Deletions and reported status changes, both dated by the copy's last edit.

    ``strict_reference`` reproduces the all-time job, whose deletion rows
    lost their test of the deleted flag.
    """
    gone = F.lit("deleted") if strict_reference and as_of is None else F.when(F.col("deleted"), "deleted")
    kinds = F.array_compact(F.array(gone, status_label(F.col("status"))))
    return copies.filter(previous_day("edit_date", as_of, strict_reference)).select(
        "root", F.col("id").alias("ac_id"), "barcode", "call_number",
        F.col("circ_lib").alias("branch_id"),
        F.explode(kinds).alias("transaction_type"),
        F.col("edit_date").alias("transaction_date"),
        F.lit(None).cast("timestamp_ntz").alias("due_date"),
    )


def transactions(
    copies: DataFrame,
    call_number: DataFrame,
    circulation: DataFrame,
    org_unit: DataFrame,
    as_of: str | None,
    strict_reference: bool = False,
) -> DataFrame:
    """Loans, returns, deletions and status changes of the scoped copies.

    Windows are applied at the scans; the copy join comes before the title
    look-up so that only events of the window travel on.
    """
    owners = copies.select("root", F.col("id").alias("ac_id"), "barcode", "call_number")
    loans = loan_events(circulation, as_of, strict_reference).join(owners, "ac_id")
    events = loans.unionByName(copy_events(copies, as_of, strict_reference))
    titles = call_number.select(F.col("id").alias("call_number"), F.col("record").alias("biblio_id"))
    branches = org_unit.select(F.col("id").alias("branch_id"), F.col("shortname").alias("transaction_branch"))
    return events.join(branches, "branch_id").join(titles, "call_number", "left").select(*COLUMNS)
