"""Copy sets and the item table of the vendor extract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfstream.functions.text import call_number_display


def exclude_modifiers(df: DataFrame, modifiers: Sequence[str] | None = None) -> DataFrame:
    """Drop copies with a listed circulation modifier.

    SQL ``NOT IN``: a copy without a modifier is dropped as well, also when the
    list is left at its default of one empty string.
    """
    return df.filter(~F.col("circ_modifier").isin(list(modifiers or [""])))


def before_day(column: str, as_of: str | None) -> Column:
    """``date(column) < as_of`` in a form the parquet scan can use."""
    if as_of is None:
        return F.lit(True)
    return F.col(column) < F.lit(as_of).cast("timestamp_ntz")


def circulating_copies(
    copy: DataFrame,
    copy_location: DataFrame,
    scope: DataFrame,
    modifiers: Sequence[str] | None = None,
    created_before: str | None = None,
    keep_deleted: bool = False,
) -> DataFrame:
    """Copies that circulate, in a circulating location of a scoped unit.

    ``created_before=None`` is the all-time variant; ``keep_deleted`` is the
    variant for transactions and holds.  Adds ``root`` and ``location_name``.
    """
    chosen = exclude_modifiers(copy, modifiers).filter(F.col("circulate")).filter(
        before_day("create_date", created_before)
    )
    if not keep_deleted:
        chosen = chosen.filter(~F.col("deleted"))
    places = copy_location.filter("circulate").select(
        F.col("id").alias("location"), F.col("name").alias("location_name")
    )
    units = scope.select("root", F.col("org_id").alias("circ_lib"))
    return chosen.join(places, "location").join(units, "circ_lib")


def item_dimensions(copies: DataFrame, org_unit: DataFrame, copy_status: DataFrame) -> DataFrame:
    """Library short name and status name of each copy (inner joins)."""
    units = org_unit.select(F.col("id").alias("circ_lib"), F.col("shortname").alias("library"))
    states = copy_status.select(F.col("id").alias("status"), F.col("name").alias("status_name"))
    return copies.join(units, "circ_lib").join(states, "status")


def volume_display(
    call_number: DataFrame, prefix: DataFrame, suffix: DataFrame
) -> DataFrame:
    """(call_number, biblio_id, call_number_text) with optional prefix and suffix."""
    pre = prefix.select(F.col("id").alias("prefix"), F.col("label").alias("pre_label"))
    suf = suffix.select(F.col("id").alias("suffix"), F.col("label").alias("suf_label"))
    return (
        call_number.join(pre, "prefix", "left")
        .join(suf, "suffix", "left")
        .select(
            F.col("id").alias("call_number"),
            F.col("record").alias("biblio_id"),
            call_number_display(F.col("pre_label"), F.col("label"), F.col("suf_label")).alias("call_number_text"),
        )
    )


def fund_by_copy(lineitem_detail: DataFrame, fund: DataFrame) -> DataFrame:
    """One fund name per copy; several matches resolve to the first by name."""
    names = fund.select(F.col("id").alias("fund"), F.col("name").alias("fund_name"))
    return (
        lineitem_detail.filter(F.col("eg_copy_id").isNotNull())
        .groupBy(F.col("eg_copy_id").alias("ac_id"), "fund")
        .agg(F.lit(1).alias("seen"))
        .join(names, "fund")
        .groupBy("ac_id")
        .agg(F.min("fund_name").alias("fund"))
    )


def isbn_text(simple_record: DataFrame) -> DataFrame:
    return simple_record.select(F.col("id").alias("biblio_id"), F.array_join("isbn", ",").alias("eans"))


def item_table(
    copies: DataFrame,
    org_unit: DataFrame,
    copy_status: DataFrame,
    volumes: DataFrame,
    isbns: DataFrame,
    funds: DataFrame,
) -> DataFrame:
    """Derived item table: copy, dimensions, volume, ISBNs and fund.

    ISBNs are attached to the volumes first (fewer rows than copies), so the
    copies move once for the volume and once for all copy-keyed joins.
    """
    described = volumes.join(isbns, "biblio_id", "left")
    return (
        item_dimensions(copies, org_unit, copy_status)
        .join(described, "call_number", "left")
        .select(
            "root",
            F.col("id").alias("ac_id"),
            "barcode",
            "biblio_id",
            "eans",
            "circ_modifier",
            F.col("call_number_text").alias("call_number"),
            F.col("location_name").alias("copy_location"),
            "library",
            F.to_date("create_date").alias("create_date"),
            F.col("status_name").alias("status"),
        )
        .join(funds, "ac_id", "left")
    )


# Status codes whose change is reported, and their labels.
STATUS_LABELS = {
    2: "Bindery",
    3: "Lost",
    4: "Missing",
    5: "In Process",
    6: "In Transit",
    8: "On Holds Shelf",
    9: "On Order",
    11: "Cataloging",
    13: "Discard/Weed",
    14: "Damaged",
}


def status_label(status: Column) -> Column:
    """Label of a reported status code, NULL for any other code."""
    pairs = [part for code, label in STATUS_LABELS.items() for part in (F.lit(code), F.lit(label))]
    return F.try_element_at(F.create_map(*pairs), status.cast("int"))
