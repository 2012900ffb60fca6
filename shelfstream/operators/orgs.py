"""Organisation tree: scopes, branch attributes and the branch file."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfstream.functions.dates import format_mmddyyyy
from shelfstream.functions.text import csv_line, csv_protect
from shelfstream.session import materialize


def org_ancestors(org_unit: DataFrame, levels: int = 6) -> DataFrame:
    """(id, ancestor) of each unit with itself and all its ancestors, however deep the tree is.

    One written table holds ``levels`` look-ups against the same parents; units whose chain goes on climb further from where
    they stopped, so an ordinary tree takes one table.  A cycle fails the job.
    """
    parents = org_unit.filter(F.col("parent_ou").isNotNull()).select(F.col("id").alias("child"), F.col("parent_ou").alias("parent"))
    climbing, found = parents.select(F.col("child").alias("id"), F.col("parent").alias("up1")), []
    while True:
        for level in range(2, levels + 2):
            step = parents.select(F.col("child").alias(f"c{level}"), F.col("parent").alias(f"up{level}"))
            climbing = climbing.join(step, F.col(f"up{level - 1}") == F.col(f"c{level}"), "left").drop(f"c{level}")
        met = F.array_compact(F.array(*[f"up{level}" for level in range(1, levels + 1)]))
        cycle = F.raise_error(F.concat(F.lit("organisation tree has a cycle at "), F.col("id").cast("string")))
        chains = climbing.select(
            "id", F.when(F.array_contains(met, F.col("id")), cycle).otherwise(met).alias("met"), F.col(f"up{levels + 1}").alias("up1")
        )
        chains = materialize(chains, "org-chains")
        found.append(chains.select("id", F.explode("met").alias("ancestor")))
        climbing = chains.filter(F.col("up1").isNotNull()).select("id", "up1")
        if climbing.isEmpty():
            break
    return reduce(DataFrame.unionAll, found, org_unit.select("id", F.col("id").alias("ancestor")))


def org_descendants(org_unit: DataFrame, roots: Sequence[str], match_case: bool = False) -> DataFrame:
    """(root, org_id) for each named root and every unit below it, roots included."""
    name = F.col("shortname") if match_case else F.lower("shortname")
    wanted = list(roots) if match_case else [root.lower() for root in roots]
    chosen = org_unit.filter(name.isin(wanted)).select(F.col("id").alias("ancestor"), F.col("shortname").alias("root"))
    return org_ancestors(org_unit).join(chosen, "ancestor").select("root", F.col("id").alias("org_id"))


def volume_owning(org_unit: DataFrame, org_unit_type: DataFrame) -> DataFrame:
    """Units of a type that may own volumes."""
    types = org_unit_type.filter("can_have_vols").select(F.col("id").alias("ou_type"))
    return org_unit.join(types, "ou_type", "left_semi")


def first_address(org_address: DataFrame) -> DataFrame:
    """Post code and address per unit: a non-mailing address comes before a mailing one."""
    street = F.concat(
        F.col("street1"), F.lit(" "), F.col("street2"), F.lit(";"), F.col("city"), F.lit(";"), F.col("state")
    )

    def order(is_mailing):
        return F.struct(F.when(is_mailing.isNull(), 2).otherwise(is_mailing.cast("int")).alias("k"), F.col("id"))

    return (
        org_address.filter(F.col("post_code").isNotNull())
        .groupBy("org_unit")
        .agg(
            F.min_by("post_code", order(F.col("address_type") == "MAILING")).alias("post_code"),
            F.min_by(street, order(F.col("address_type").rlike("(?i)MAILING"))).alias("address"),
        )
    )


def org_lookup(org_unit: DataFrame, org_address: DataFrame) -> DataFrame:
    address = first_address(org_address)
    return (
        org_unit.join(address, org_unit["id"] == address["org_unit"], "left")
        .select("id", "shortname", "name", "post_code", "address")
    )


def agg_patrons(usr: DataFrame) -> DataFrame:
    return (
        usr.filter(~F.col("deleted") & F.col("active"))
        .groupBy("home_ou")
        .agg(F.count("id").alias("patron_count"))
    )


def branch_file(
    org_unit: DataFrame,
    org_unit_type: DataFrame,
    org_address: DataFrame,
    usr: DataFrame,
    roots: Sequence[str],
    as_of: str,
) -> DataFrame:
    """One row per volume-owning branch below each root."""
    scope = org_descendants(org_unit, roots, match_case=True)
    branches = volume_owning(org_unit, org_unit_type)
    lookup = org_lookup(branches, org_address)
    patrons = agg_patrons(usr)
    return (
        scope.join(lookup, scope["org_id"] == lookup["id"])
        .join(patrons, F.col("id") == patrons["home_ou"], "left")
        .select(
            F.col("root").alias("system_code"),
            F.col("shortname").alias("branch_code"),
            F.col("name").alias("branch_name"),
            F.col("post_code").alias("postal_code"),
            F.col("address"),
            F.coalesce("patron_count", F.lit(0)).cast("bigint").alias("user_count"),
            format_mmddyyyy(F.lit(as_of).cast("date")).alias("date_end"),
        )
    )


BRANCH_HEADER = "System_Code,Branch_Code,Branch_Name,Postal_Code,Address,User_Count,DateEnd"


def branch_lines(branches: DataFrame) -> DataFrame:
    protected = [csv_protect(F.col(c), trim=False) for c in ("branch_name", "postal_code", "address")]
    return branches.select(
        csv_line(
            [F.col("system_code"), F.col("branch_code"), *protected, F.col("user_count").cast("string"), F.col("date_end")]
        ).alias("line")
    )
