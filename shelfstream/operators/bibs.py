"""Bibliographic extract: MARC columns and the incremental title table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstream.functions.marc import marc_one_element, marc_title, parse_marc

BIB_COLUMNS = (
    "biblio_id", "eans", "material_type", "title", "author", "series", "pub_date", "publisher_supplier", "price",
    "last_update",
)


BIB_TABLE_SCHEMA = "root string, " + ", ".join(
    f"{c} {t}" for c, t in zip(BIB_COLUMNS, ["bigint", *["string"] * 8, "timestamp_ntz"])
)


def distinct_bibs(copies: DataFrame, call_number: DataFrame) -> DataFrame:
    """(root, biblio_id) of titles with a circulating copy in scope."""
    titles = call_number.select(F.col("id").alias("call_number"), F.col("record").alias("biblio_id"))
    # copies of one volume fold into one row before the join
    volumes = copies.select("root", "call_number").distinct()
    return volumes.join(titles, "call_number").select("root", "biblio_id").distinct()


def material_types(record_attr_flat: DataFrame) -> DataFrame:
    """Sorted array of a title's search formats, repeats kept.

    Equal values are counted first, so only distinct values are gathered.
    """
    counted = (
        record_attr_flat.filter(F.col("attr") == "search_format")
        .groupBy(F.col("id").alias("biblio_id"), "value")
        .agg(F.count(F.lit(1)).cast("int").alias("n"))
    )
    pairs = F.array_sort(F.collect_list(F.struct("value", "n")))
    return counted.groupBy("biblio_id").agg(
        F.flatten(F.transform(pairs, lambda p: F.array_repeat(p["value"], p["n"]))).alias("material_type")
    )


def bib_fields(
    record_entry: DataFrame, simple_record: DataFrame, record_attr_flat: DataFrame
) -> DataFrame:
    """Title columns of the extract, arrays joined by commas; one XML parse per record."""
    fields = F.col("fields")

    def joined(tags, code):
        return F.array_join(marc_one_element(fields, tags, code), ",")

    marc = record_entry.select(F.col("id").alias("biblio_id"), parse_marc(F.col("marc")).alias("fields")).select(
        "biblio_id",
        marc_title(fields).alias("title"),
        joined(("490",), "a").alias("series"),
        joined(("260", "264"), "c").alias("pub_date"),
        joined(("260", "264"), "b").alias("publisher_supplier"),
        joined(("020", "024"), "c").alias("price"),
    )
    simple = simple_record.select(
        F.col("id").alias("biblio_id"), F.array_join("isbn", ",").alias("eans"), "author"
    )
    formats = material_types(record_attr_flat).select(
        "biblio_id", F.array_join("material_type", ",").alias("material_type")
    )
    return (
        marc.join(simple, "biblio_id", "left")
        .join(formats, "biblio_id", "left")
        .select(*BIB_COLUMNS[:-1])
    )


def without_deleted(bibs: DataFrame, record_entry: DataFrame) -> DataFrame:
    gone = record_entry.filter("deleted").select(F.col("id").alias("biblio_id"))
    return bibs.join(gone, "biblio_id", "left_anti")


def bib_keys(bibs: DataFrame) -> list[str]:
    """A table that serves several exported roots is keyed by root and title."""
    return ["root", "biblio_id"] if "root" in bibs.columns else ["biblio_id"]


def missing_bibs(active: DataFrame, bibs: DataFrame) -> DataFrame:
    """Active titles the extract does not hold yet."""
    keys = bib_keys(bibs)
    return active.select(*keys).distinct().join(bibs.select(*keys), keys, "left_anti")


def mark_stale(bibs: DataFrame, record_entry: DataFrame) -> DataFrame:
    """Clear ``last_update`` of rows older than the record's last edit."""
    edits = record_entry.select(F.col("id").alias("biblio_id"), F.col("edit_date").alias("_edited"))
    stale = F.col("last_update") < F.col("_edited")
    return (
        bibs.join(edits, "biblio_id", "left")
        .withColumn("last_update", F.when(~F.coalesce(stale, F.lit(False)), F.col("last_update")))
        .drop("_edited")
    )


def refresh_list(bibs: DataFrame, active: DataFrame, record_entry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, pending): rows that stay as they are, and ids whose columns must be rebuilt."""
    marked = mark_stale(without_deleted(bibs, record_entry), record_entry)
    kept = marked.filter("last_update IS NOT NULL")
    stale = marked.filter("last_update IS NULL").select(*bib_keys(bibs))
    return kept, stale.unionByName(missing_bibs(active, without_deleted(bibs, record_entry)))


def update_backlog(bibs: DataFrame, active: DataFrame, record_entry: DataFrame) -> DataFrame:
    _, pending = refresh_list(bibs, active, record_entry)
    return pending.agg(F.count("biblio_id").alias("backlog"))


def upsert_bibs(
    bibs: DataFrame,
    active: DataFrame,
    record_entry: DataFrame,
    simple_record: DataFrame,
    record_attr_flat: DataFrame,
    refreshed_at: str,
) -> DataFrame:
    """Next state of the incremental title table.

    Deleted titles leave, new ones enter, and only new or stale titles have
    their MARC parsed again.  Write the result to a new path and then switch
    readers over: the input table stays readable while the job runs.
    """
    kept, pending = refresh_list(bibs, active, record_entry)
    wanted = pending.select(F.col("biblio_id").alias("id")).distinct()
    rebuilt = bib_fields(
        record_entry.join(wanted, "id", "left_semi"),
        simple_record.join(wanted, "id", "left_semi"),
        record_attr_flat.join(wanted, "id", "left_semi"),
    )
    stamped = pending.join(rebuilt, "biblio_id", "left").withColumn(
        "last_update", F.lit(refreshed_at).cast("timestamp_ntz")
    )
    columns = [*bib_keys(bibs), *BIB_COLUMNS[1:]]
    return kept.select(*columns).unionByName(stamped.select(*columns))
