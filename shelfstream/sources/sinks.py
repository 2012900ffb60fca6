"""Delimited text outputs and the run audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from shelfstream.functions.text import blank_if_null, csv_line, csv_protect


@dataclass(frozen=True)
class CsvLayout:
    """Header and fields of a vendor file.

    ``fields`` names the row columns in file order; those in ``protected`` are
    quoted by :func:`csv_protect`.  The header is a fixed text, not derived
    from the fields: some agreed headers differ from the data.
    """

    header: str
    fields: tuple[str, ...]
    protected: frozenset[str]


_ITEM_FIELDS = (
    "ac_id", "barcode", "biblio_id", "eans", "circ_modifier", "call_number", "copy_location", "library", "create_date",
    "status", "last_circ", "last_checkin", "last_due", "monthly_circs", "annual_circs", "all_circs", "fund",
)
_ITEM_HEADER = (
    "copy_id,barcode,biblio_id,eans,circ_modifier,call_number,copy_location,library,create_date,"
    "status,last_circ,last_checkin,last_due,monthly_circs,annual_circs,all_circs,fund"
)
_ITEM_TEXT = frozenset(
    ("barcode", "eans", "circ_modifier", "itype", "call_number", "copy_location", "library", "status", "fund")
)

# Agreed headers and field orders of the vendor files.
ITEMS = CsvLayout(_ITEM_HEADER, _ITEM_FIELDS, _ITEM_TEXT)
KOHA_ITEMS = CsvLayout(
    _ITEM_HEADER.replace("circ_modifier", "itype"),
    tuple("itype" if f == "circ_modifier" else f for f in _ITEM_FIELDS),
    _ITEM_TEXT,
)
ORDERS = CsvLayout("biblio_id,hold_count,holds_branch", ("biblio_id", "order_count", "branch"), frozenset(("branch",)))
KOHA_ORDERS = CsvLayout(
    "biblio_id,hold_count,holds_branch", ("biblio_id", "hold_count", "holds_branch"), frozenset(("holds_branch",))
)
HOLDS = CsvLayout(
    "biblio_id,hold_count,holds_branch", ("biblio_id", "hold_type", "hold_count", "holds_branch"),
    frozenset(("holds_branch",)),
)
HOLDS_ALLTIME = CsvLayout(
    "biblio_id,hold_count,holds_branch", ("biblio_id", "hold_count", "holds_branch"), frozenset(("holds_branch",))
)
CIRCS = CsvLayout(
    "copy_id,barcode,biblio_id,transaction_type,transaction_date,transaction_branch,due_date",
    ("ac_id", "barcode", "biblio_id", "transaction_type", "transaction_day", "transaction_branch", "due_day"),
    frozenset(("barcode", "transaction_type", "transaction_branch")),
)
BIBS = CsvLayout(
    "biblio_id,eans,material_type,title,author,series,pub_date,publisher_supplier,price",
    ("biblio_id", "eans", "material_type", "title", "author", "series", "pub_date", "publisher_supplier", "price"),
    frozenset(("eans", "material_type", "title", "author", "series", "pub_date", "publisher_supplier", "price")),
)
METARECORDS = CsvLayout("metarecord,biblio_id", ("metarecord", "biblio_id"), frozenset())


def with_days(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("transaction_day", F.to_date("transaction_date")).withColumn(
        "due_day", F.to_date("due_date")
    )


def csv_lines(rows: DataFrame, layout: CsvLayout, keep: tuple[str, ...] = ()) -> DataFrame:
    """One ``line`` per row; ``keep`` carries partition columns such as ``root`` along."""
    cells = [
        csv_protect(F.col(f)) if f in layout.protected else blank_if_null(F.col(f)) for f in layout.fields
    ]
    return rows.select(*keep, csv_line(cells).alias("line"))


def with_header(lines: DataFrame, header: str) -> DataFrame:
    """Header line ahead of the rows.

    A union keeps its inputs' partitions in order, so the header opens the
    first part file without sorting or gathering the rows.
    """
    spark = lines.sparkSession
    return spark.range(1).select(F.lit(header).alias("line")).unionByName(lines.select("line"))


def write_lines(lines: DataFrame, path: str, line_separator: str = "\n", gzip: bool = False) -> None:
    """Text part files that concatenate in name order (gzip members may be concatenated too)."""
    writer = lines.select("line").write.option("lineSep", line_separator)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.text(path)


def write_csv(rows: DataFrame, layout: CsvLayout, path: str, line_separator: str = "\n") -> int:
    """Write one vendor file and return its row count, counted while it is written."""
    lines = csv_lines(rows, layout)
    observed = Observation()
    counted = lines.observe(observed, F.count(F.lit(1)).alias("rows"))
    write_lines(with_header(counted, layout.header), path, line_separator)
    return observed.get["rows"]


UNIT_FILE_SCHEMA = "line string, root string"


def write_unit_files(rows: DataFrame, layout: CsvLayout, path: str, units: Sequence[str], line_separator: str = "\n") -> dict[str, int]:
    """A finished vendor file per unit below ``path``, in one pass; returns the rows of each unit.

    ``rows`` carry their unit as ``root``.  Unit R's file is the folder ``root=R``: its part files in name order, the first
    of which is the header line, so a unit without rows has a file too.  The headers are the first partition of a union, which
    keeps its inputs' partitions in order: nothing is sorted or shuffled.  Tasks write to attempt folders and only a finished
    job moves their parts in place, so a failed or repeated task leaves no half file.  A rerun replaces the files.  Rows
    are counted by the tasks that write them; each task counts once, however often it is tried.
    """
    spark = rows.sparkSession
    observed, root = Observation(), F.coalesce("root", F.lit(""))
    counts = [F.count_if(F.col("root") == unit).alias(f"unit_{k}") for k, unit in enumerate(units)]
    elsewhere = F.count_if(~F.coalesce(F.col("root").isin(*units), F.lit(False))).alias("elsewhere")
    lines = csv_lines(rows, layout, keep=("root",)).observe(observed, elsewhere, *counts)
    headers = spark.range(0, 1, 1, 1).select(
        F.explode(F.array(*[F.lit(unit) for unit in units])).alias("root"), F.lit(layout.header).alias("line")
    )
    (
        headers.unionByName(lines).select(root.alias("root"), "line")
        .write.mode("overwrite").option("lineSep", line_separator).partitionBy("root").text(path)
    )
    if observed.get["elsewhere"]:
        raise ValueError(f"{observed.get['elsewhere']} rows belong to none of the units {list(units)}")
    return {unit: observed.get[f"unit_{k}"] for k, unit in enumerate(units)}


def read_unit_files(spark: SparkSession, path: str) -> DataFrame:
    """(line, root) of the finished files, header lines included."""
    return spark.read.schema(UNIT_FILE_SCHEMA).text(path)


def write_dat(bib_rows: DataFrame, item_rows: DataFrame, library: str, extract_date: str, path: str) -> tuple[int, int]:
    """Gzip text sections in name order: header, title rows, copy rows, trailer.

    Rows are counted while they are written, so neither set is computed twice.
    """
    spark = bib_rows.sparkSession
    stamp = extract_date.replace("-", "")

    def one_line(text, folder):
        write_lines(spark.range(1).select(F.lit(text).alias("line")), f"{path}/{folder}", gzip=True)

    one_line(f"##HEADER##,##DAT##,##{stamp}##,##{library}##,,,##USA##", "0_header")
    counts = []
    for rows, folder in ((bib_rows, "1_bibs"), (item_rows, "2_items")):
        observed = Observation()
        write_lines(rows.observe(observed, F.count(F.lit(1)).alias("rows")), f"{path}/{folder}", gzip=True)
        counts.append(observed.get["rows"])
    one_line(f"##TRAILER##,{counts[0]},{counts[1]}", "3_trailer")
    return counts[0], counts[1]


AUDIT_SCHEMA = "event string, root string, rows bigint, event_time timestamp_ntz, run_date string, file string"
ALL_UNITS = ""


def write_audit(spark: SparkSession, path: str, run_date: str, file: str, rows: Mapping[str, int]) -> None:
    """Set the audit rows of one output of one run: a row per unit (``ALL_UNITS`` for a file of no single unit).

    The table is partitioned by run and file and only that partition is replaced, so a rerun does not double its rows.
    """
    units = F.explode(F.create_map(*[x for unit, n in rows.items() for x in (F.lit(unit), F.lit(n).cast("bigint"))]))
    entry = spark.range(1).select(units.alias("root", "rows")).select(
        F.lit(f"{file} file generated").alias("event"), "root", "rows",
        F.current_timestamp().cast("timestamp_ntz").alias("event_time"), F.lit(run_date).alias("run_date"), F.lit(file).alias("file"),
    )
    entry.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "file").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)
