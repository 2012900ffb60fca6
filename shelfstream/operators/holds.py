"""Holds: as-of filters and resolution of typed targets to titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstream.operators.copies import before_day


def open_holds(hold_request: DataFrame, as_of: str) -> DataFrame:
    """Holds placed before the day that had not ended by it."""
    day = F.lit(as_of).cast("timestamp_ntz")
    chosen = hold_request.filter(before_day("request_time", as_of))
    for ended in ("cancel_time", "capture_time", "fulfillment_time"):
        chosen = chosen.filter(F.col(ended).isNull() | (F.col(ended) > day))
    return chosen


def scoped_holds(holds: DataFrame, scope: DataFrame, org_unit: DataFrame) -> DataFrame:
    """Holds picked up in a scoped unit, with the pickup branch's short name."""
    units = org_unit.select(F.col("id").alias("pickup_lib"), F.col("shortname").alias("holds_branch"))
    return holds.join(scope.select("root", F.col("org_id").alias("pickup_lib")), "pickup_lib").join(units, "pickup_lib")


def hold_items(copies: DataFrame, call_number: DataFrame) -> DataFrame:
    """(root, ac_id, acn_id, biblio_id) of the copies a hold may target."""
    titles = call_number.select(F.col("id").alias("call_number"), F.col("record").alias("biblio_id"))
    return copies.join(titles, "call_number", "left").select(
        "root", F.col("id").alias("ac_id"), F.col("call_number").alias("acn_id"), "biblio_id"
    )


def target_resolver(items: DataFrame, copy_part_map: DataFrame, metarecord_source_map: DataFrame) -> DataFrame:
    """(root, kind, key, biblio_id): one title per resolvable target.

    Several candidate titles resolve to the lowest id.  Metarecords do not
    depend on the scope and carry an empty root.
    """
    known = items.filter("biblio_id IS NOT NULL")

    parts = copy_part_map.select("part", F.col("target_copy").alias("ac_id"))
    ways = {"title": "biblio_id", "volume": "acn_id", "copy": "ac_id", "part": "part"}
    targets = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(key).alias("key")) for kind, key in ways.items()])
    own = (
        known.join(parts, "ac_id", "left")
        .select("root", F.explode(targets).alias("t"), "biblio_id")
        .select("root", "t.kind", "t.key", "biblio_id")
        .filter("key IS NOT NULL")
    )
    sources = metarecord_source_map.select(
        F.lit("").alias("root"),
        F.lit("metarecord").alias("kind"),
        F.col("metarecord").alias("key"),
        F.col("source").alias("biblio_id"),
    )
    return own.unionByName(sources).groupBy("root", "kind", "key").agg(F.min("biblio_id").alias("biblio_id"))


def resolve_targets(holds: DataFrame, resolver: DataFrame, metarecord_source_map: DataFrame) -> DataFrame:
    """Attach the title a hold stands for; holds without one are dropped.

    All six target types go through one equi-join.  A metarecord hold with a
    current copy follows that copy, and must name a metarecord that exists.
    """
    kind = (
        F.when(F.col("hold_type") == "T", "title")
        .when(F.col("hold_type") == "V", "volume")
        .when(F.col("hold_type").isin("C", "F", "R"), "copy")
        .when(F.col("hold_type") == "P", "part")
        .when((F.col("hold_type") == "M") & F.col("current_copy").isNotNull(), "copy")
        .when(F.col("hold_type") == "M", "metarecord")
    )
    key = F.when((F.col("hold_type") == "M") & F.col("current_copy").isNotNull(), F.col("current_copy")).otherwise(
        F.col("target")
    )
    typed = holds.withColumn("kind", kind).withColumn("key", key)
    typed = typed.withColumn("scope_root", F.when(F.col("kind") != "metarecord", F.col("root")).otherwise(""))
    titles = resolver.withColumnRenamed("root", "scope_root")
    resolved = typed.join(titles, ["scope_root", "kind", "key"]).drop("kind", "key", "scope_root")
    # One pass for all types: only metarecord holds can meet a row of the right side,
    # and the others spread by their own target.
    known = metarecord_source_map.select(
        F.lit(True).alias("_grouped"), F.col("metarecord").alias("target"), F.lit(True).alias("_known")
    ).distinct()
    return (
        resolved.withColumn("_grouped", F.col("hold_type") == "M")
        .join(known, ["_grouped", "target"], "left")
        .filter(~F.col("_grouped") | F.col("_known"))
        .drop("_grouped", "_known")
    )


def fold_holds(holds: DataFrame) -> DataFrame:
    """Equal holds as one row with a count, so a title with a third of all holds moves as few rows."""
    copy = F.when(F.col("hold_type") == "M", F.col("current_copy"))
    return holds.groupBy(
        "root", "hold_type", "target", "holds_branch", copy.alias("current_copy")
    ).agg(F.count("id").alias("n"))


def hold_counts(folded: DataFrame, resolver: DataFrame, metarecord_source_map: DataFrame) -> DataFrame:
    """Open holds per title, type and branch."""
    return (
        resolve_targets(folded, resolver, metarecord_source_map)
        .groupBy("root", "biblio_id", "hold_type", "holds_branch")
        .agg(F.sum("n").alias("hold_count"))
    )


def held_metarecords(folded: DataFrame, resolver: DataFrame, metarecord_source_map: DataFrame) -> DataFrame:
    """Source titles of every metarecord that has a resolved hold, per exported root."""
    held = (
        resolve_targets(folded.filter("hold_type = 'M'"), resolver, metarecord_source_map)
        .select("root", F.col("target").alias("metarecord"))
        .distinct()
    )
    sources = metarecord_source_map.select("metarecord", F.col("source").alias("biblio_id")).distinct()
    return held.join(sources, "metarecord").select("root", "metarecord", "biblio_id")
