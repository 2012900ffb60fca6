"""Weekly lending figures per branch and title."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstream.functions.dates import format_mmddyyyy
from shelfstream.functions.text import csv_line, extract_isbns
from shelfstream.operators.orgs import org_descendants, volume_owning
from shelfstream.session import materialize

ON_ORDER_STATUS = 9
LENDING_HEADER = "BranchCode,CatalogueKey,EAN_ISBN13,Loans,Renewals,Holds,Copies,CopiesOut,CopiesOnOrder,DateEnd"
COUNTS = ("loans", "renewals", "holds", "copies", "copies_out", "copies_on_order")


def isbn_normalize(simple_record: DataFrame) -> DataFrame:
    """(biblio_id, isbns): distinct canonical ISBN-13s of each title."""
    return simple_record.select(
        F.col("id").alias("biblio_id"), extract_isbns(F.array_join("isbn", ";")).alias("isbns")
    )


def lending(
    org_unit: DataFrame,
    org_unit_type: DataFrame,
    copy: DataFrame,
    circulation: DataFrame,
    hold_request: DataFrame,
    call_number: DataFrame,
    simple_record: DataFrame,
    roots: list[str],
    as_of: str,
) -> DataFrame:
    """Loans, renewals, waiting holds, copies, copies out and on order.

    Every fact is counted per copy before it is joined, so there is no fan-out
    to undo with COUNT(DISTINCT), and all branches come from one pass.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    branches = materialize(
        org_descendants(org_unit, roots, match_case=True)
        .join(volume_owning(org_unit, org_unit_type).select(F.col("id").alias("org_id"), "shortname"), "org_id")
        .select(F.col("org_id").alias("circ_lib"), F.col("shortname").alias("branch"))
        .distinct(),
        "branches",
    )
    copies = (
        copy.filter(~F.col("deleted"))
        .join(branches.select("circ_lib"), "circ_lib", "left_semi")
        .select("id", "call_number", "circ_lib", (F.col("status") == ON_ORDER_STATUS).alias("on_order"))
    )
    recent = F.col("xact_start") > now - F.expr("INTERVAL '7' DAY")
    out_now = F.col("checkin_time").isNull() & F.col("xact_finish").isNull()
    loans = (
        circulation.filter(recent | out_now)
        .groupBy(F.col("target_copy").alias("id"))
        .agg(
            F.count(F.when(recent, 1)).alias("loans"),
            F.count(F.when(recent & F.col("parent_circ").isNotNull(), 1)).alias("renewals"),
            F.count(F.when(out_now, 1)).alias("copies_out"),
        )
    )
    holds = (
        hold_request.filter(
            F.col("capture_time").isNotNull() & F.col("fulfillment_time").isNull() & F.col("current_copy").isNotNull()
        )
        .groupBy(F.col("current_copy").alias("id"), F.col("pickup_lib").alias("circ_lib"))
        .agg(F.count(F.lit(1)).alias("holds"))
    )
    per_volume = (
        copies.join(loans, "id", "left")
        .join(holds, ["id", "circ_lib"], "left")
        .groupBy("circ_lib", "call_number")
        .agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("loans", "renewals", "holds", "copies_out")],
            F.count("id").alias("copies"),
            F.count(F.when(F.col("on_order"), 1)).alias("copies_on_order"),
        )
    )
    titles = call_number.select(F.col("id").alias("call_number"), F.col("record").alias("biblio_id"))
    return (
        per_volume.join(titles, "call_number")
        .groupBy("circ_lib", "biblio_id")
        .agg(*[F.sum(c).alias(c) for c in COUNTS])
        .join(isbn_normalize(simple_record), "biblio_id")
        .join(branches, "circ_lib")
        .select(
            F.col("branch").alias("branch_code"),
            F.col("biblio_id").alias("catalogue_key"),
            "isbns",
            *COUNTS,
            format_mmddyyyy(F.lit(as_of).cast("date")).alias("date_end"),
        )
    )


def lending_lines(rows: DataFrame) -> DataFrame:
    columns = ["branch_code", "catalogue_key", "isbns", *COUNTS, "date_end"]
    return rows.select(csv_line([F.col(c) for c in columns]).alias("line"))
