"""Acquisition orders per title and branch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def order_counts(
    purchase_order: DataFrame,
    lineitem: DataFrame,
    lineitem_detail: DataFrame,
    org_unit: DataFrame,
    scope: DataFrame,
) -> DataFrame:
    """Details of new or on-order lines, ordered by a scoped agency.

    Details of other lines go first; the rest are counted per line and branch
    before they meet the order, so a line with very many details moves as one
    row per branch.
    """
    agencies = scope.select("root", F.col("org_id").alias("ordering_agency"))
    orders = purchase_order.join(agencies, "ordering_agency").select("root", F.col("id").alias("purchase_order"))
    lines = (
        lineitem.filter(F.col("state").isin("new", "on-order"))
        .join(orders, "purchase_order")
        .select("root", F.col("id").alias("lineitem"), F.col("eg_bib_id").alias("biblio_id"))
    )
    details = lineitem_detail.join(lines.select("lineitem"), "lineitem", "left_semi").groupBy("lineitem", "owning_lib").agg(F.count("id").alias("n"))
    branches = org_unit.select(F.col("id").alias("owning_lib"), F.col("shortname").alias("branch"))
    return (
        details.join(lines, "lineitem")
        .groupBy("root", "biblio_id", "owning_lib")
        .agg(F.sum("n").alias("n"))
        .join(branches, "owning_lib")
        .groupBy("root", "biblio_id", "branch")
        .agg(F.sum("n").alias("order_count"))
    )
