"""Collection-analysis extract: one text row per copy and per title."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstream.functions.dates import yyyymmdd
from shelfstream.functions.marc import first_field_value, parse_marc, subject_string
from shelfstream.functions.text import (
    attempt_price,
    attempt_year,
    blank_if_null,
    hash_quote,
    isbn_token,
    naco_normalize,
    price_fallback,
)

NOTE_PATTERN = "%collectionHQ%"


def first_isbn(full_rec: DataFrame) -> DataFrame:
    """One ISBN per record: the longest 020 token under 14 characters, then the lowest."""
    tokens = (
        full_rec.filter((F.col("tag") == "020") & F.col("subfield").isin("a", "z"))
        .select(F.col("record").alias("biblio_id"), isbn_token(F.col("value")).alias("token"))
        .filter(F.length("token") < 14)
    )
    return tokens.groupBy("biblio_id").agg(
        F.min_by("token", F.struct((-F.length("token")).alias("n"), F.col("token"))).alias("isbn")
    )


def first_note(copy_note: DataFrame) -> DataFrame:
    """First 100 characters of the lowest-numbered note with the agreed title."""
    return (
        copy_note.filter(F.col("title").ilike(NOTE_PATTERN))
        .groupBy(F.col("owning_copy").alias("ac_id"))
        .agg(F.min_by("value", "id").alias("note"))
        .select("ac_id", F.substring("note", 1, 100).alias("note"))
    )


def any_item_type(copies: DataFrame, call_number: DataFrame) -> DataFrame:
    """One circulation modifier per title; the lowest, where the choice is open."""
    live = call_number.filter(~F.col("deleted")).select(
        F.col("id").alias("call_number"), F.col("record").alias("biblio_id")
    )
    per_volume = copies.filter(~F.col("deleted")).groupBy("call_number").agg(F.min("circ_modifier").alias("item_type"))
    return per_volume.join(live, "call_number").groupBy("biblio_id").agg(F.min("item_type").alias("item_type"))


def _in_scope(df: DataFrame, scope: DataFrame, column: str) -> DataFrame:
    return df.join(scope.select(F.col("org_id").alias(column)), column, "left_semi")


def scoped_copies(copy: DataFrame, scope: DataFrame) -> DataFrame:
    """Copies in use whose library is in the scope."""
    return _in_scope(copy.filter(~F.col("deleted")), scope, "circ_lib")


def collection_items(
    copy: DataFrame,
    copy_location: DataFrame,
    call_number: DataFrame,
    org_unit: DataFrame,
    circulation_summary: DataFrame,
    copy_note: DataFrame,
    full_rec: DataFrame,
    record_entry: DataFrame,
    scope: DataFrame,
) -> DataFrame:
    """Columns of the copy rows, before quoting."""
    chosen = scoped_copies(copy, scope).withColumn(
        "copy_price", attempt_price(F.col("price").cast("string"))
    )
    volumes = call_number.select(F.col("id").alias("call_number"), F.col("record").alias("biblio_id"), "label")

    # Only titles of copies without a price of their own have their MARC parsed.
    unpriced = (
        chosen.filter(F.coalesce(F.col("copy_price"), F.lit("")) == "")
        .select("call_number").distinct()
        .join(volumes.select("call_number", F.col("biblio_id").alias("id")), "call_number")
        .select("id")
    )
    title_prices = (
        record_entry.join(unpriced, "id", "left_semi")
        .select(F.col("id").alias("biblio_id"), parse_marc(F.col("marc")).alias("fields"))
        .select("biblio_id", attempt_price(first_field_value(F.col("fields"), "020", "c")).alias("title_price"))
    )
    described = volumes.join(first_isbn(full_rec), "biblio_id", "left").join(title_prices, "biblio_id", "left")
    units = org_unit.select(F.col("id").alias("circ_lib"), F.col("shortname").alias("library_code"))
    places = copy_location.select(F.col("id").alias("location"), F.col("name").alias("collection_code"))
    return (
        chosen.join(units, "circ_lib", "left")
        .join(places, "location", "left")
        .join(described, "call_number")
        .withColumnRenamed("id", "ac_id")
        .join(circulation_summary, "ac_id", "left")
        .join(first_note(copy_note), "ac_id", "left")
        .select(
            "ac_id", "biblio_id", "library_code", "last_circ_lib", "barcode",
            yyyymmdd(F.col("last_use")).alias("last_use_date"),
            F.coalesce(F.col("circ_count"), F.lit(0)).cast("string").alias("use_total"),
            F.col("status").cast("string").alias("status"),
            yyyymmdd(F.col("create_date")).alias("date_added"),
            price_fallback(F.col("copy_price"), F.col("title_price")).alias("price"),
            F.when(F.col("floating") > 0, "Y").alias("rotating_stock"),
            "note", "collection_code", F.col("label").alias("filter_level_1"), "isbn",
        )
    )


def collection_item_rows(items: DataFrame, authority: str, extract_date: str) -> DataFrame:
    """``##HOLD##`` rows; the use count since arrival is always ``0`` and a blank."""
    quoted = {c: hash_quote(F.col(c)) for c in items.columns}
    blank = F.lit("")
    day = hash_quote(yyyymmdd(F.lit(extract_date).cast("date")))
    cells = [
        F.lit("##HOLD##"), F.col("biblio_id").cast("string"), hash_quote(F.lit(authority)),
        quoted["library_code"], quoted["last_circ_lib"], quoted["barcode"], quoted["last_use_date"],
        F.col("use_total"), F.lit("0 "), quoted["status"], quoted["date_added"], blank_if_null(F.col("price")),
        blank, quoted["rotating_stock"], blank, blank, quoted["note"], day, quoted["collection_code"], blank,
        quoted["filter_level_1"], blank, blank, blank, quoted["isbn"],
    ]
    return items.filter("biblio_id IS NOT NULL").select("ac_id", F.concat_ws(",", *cells).alias("line"))


def collection_bibs(
    record_entry: DataFrame,
    call_number: DataFrame,
    copy: DataFrame,
    simple_record: DataFrame,
    full_rec: DataFrame,
    scope: DataFrame,
) -> DataFrame:
    """Columns of the title rows for undeleted titles with undeleted volumes in scope."""
    held = (
        _in_scope(call_number.filter(~F.col("deleted")), scope, "owning_lib")
        .select(F.col("record").alias("id")).distinct()
    )
    fields = F.col("fields")

    def cut(value, length):
        return F.substring(value, 1, length)

    marc = (
        record_entry.filter(~F.col("deleted"))
        .join(held, "id", "left_semi")
        .select(F.col("id").alias("biblio_id"), parse_marc(F.col("marc")).alias("fields"))
        .select(
            "biblio_id",
            cut(naco_normalize(first_field_value(fields, "250", "a")), 20).alias("edition"),
            attempt_year(first_field_value(fields, "260", "c")).alias("publication_date"),
            cut(naco_normalize(first_field_value(fields, "260", "b")), 100).alias("publisher"),
            attempt_price(first_field_value(fields, "020", "c")).alias("price"),
            cut(naco_normalize(first_field_value(fields, "082", "a")), 20).alias("class_num"),
            subject_string(fields, "650", naco_normalize).alias("subject"),
            subject_string(fields, "655", naco_normalize).alias("genre"),
        )
    )
    simple = simple_record.select(
        F.col("id").alias("biblio_id"), cut(F.col("title"), 100).alias("title"), cut(F.col("author"), 50).alias("author"),
        F.lit(True).alias("has_simple"),
    )
    copies = _in_scope(copy, scope, "circ_lib")
    return (
        marc.join(simple, "biblio_id", "left")
        .join(first_isbn(full_rec), "biblio_id", "left")
        .join(any_item_type(copies, call_number), "biblio_id", "left")
        .withColumn("isbn", F.when(F.col("has_simple"), F.col("isbn")))
        .drop("has_simple")
    )


def collection_bib_rows(bibs: DataFrame, service: str, extract_date: str) -> DataFrame:
    """``##BIB##`` rows."""
    quoted = {c: hash_quote(F.col(c)) for c in bibs.columns}
    day = hash_quote(yyyymmdd(F.lit(extract_date).cast("date")))
    cells = [
        F.lit("##BIB##"), F.col("biblio_id").cast("string"), hash_quote(F.lit(service)), quoted["isbn"],
        quoted["title"], quoted["author"], quoted["edition"], quoted["publication_date"], quoted["publisher"],
        blank_if_null(F.col("price")), quoted["item_type"], quoted["class_num"], day, quoted["subject"], quoted["genre"],
    ]
    return bibs.select("biblio_id", F.concat_ws(",", *cells).alias("line"))


def dat_lines(bib_rows: DataFrame, item_rows: DataFrame, library: str, extract_date: str) -> DataFrame:
    """Header, title rows, copy rows and a trailer with both counts.

    ``section`` and ``key`` give the order within the file.
    """
    spark = bib_rows.sparkSession
    stamp = extract_date.replace("-", "")
    header = spark.range(1).select(
        F.lit(0).alias("section"), F.lit(0).cast("bigint").alias("key"),
        F.lit(f"##HEADER##,##DAT##,##{stamp}##,##{library}##,,,##USA##").alias("line"),
    )
    bibs = bib_rows.select(F.lit(1).alias("section"), F.col("biblio_id").alias("key"), "line")
    items = item_rows.select(F.lit(2).alias("section"), F.col("ac_id").alias("key"), "line")
    counted = bib_rows.select(F.lit(1).alias("b"), F.lit(0).alias("i")).unionByName(
        item_rows.select(F.lit(0).alias("b"), F.lit(1).alias("i"))
    )
    trailer = counted.agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("b"), F.coalesce(F.sum("i"), F.lit(0)).alias("i")
    ).select(
        F.lit(3).alias("section"), F.lit(0).cast("bigint").alias("key"),
        F.concat_ws(",", F.lit("##TRAILER##"), F.col("b").cast("string"), F.col("i").cast("string")).alias("line"),
    )
    return header.unionByName(bibs).unionByName(items).unionByName(trailer)
