"""Export jobs: the operators put together into vendor files and reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfstream.functions import marc
from shelfstream.operators import (
    bibs, circulation as circ, collection, copies, holds, koha, lending, orders, orgs, ratio, transactions,
)
from shelfstream.plans.reports import Report, run_report
from shelfstream.session import configure_session, fresh_path, materialize
from shelfstream.sources import sinks
from shelfstream.sources.bib_table import BUCKETS, BibTable
from shelfstream.sources.sinks import CsvLayout

# The historical job runs as of a day before all data, so its windows take every loan.
HISTORICAL_DATE = "1800-01-01"
FILES = ("item", "order", "circ", "hold", "bib")


@dataclass(frozen=True)
class Settings:
    """What one export run is about; every date is explicit, nothing reads the clock.

    ``strict_reference`` brings back known slips of the original: in all-time files every copy is deleted and events
    without a time are kept, and the second system's EANs are joined on the item number.
    """

    run_date: str
    scope_roots: tuple[str, ...]
    excluded_modifiers: tuple[str, ...] | None = None
    branch_roots: tuple[str, ...] = ()
    lending_date: str | None = None
    collection_root: str | None = None
    authority_code: str = "AUTH"
    service_code: str = "SVC"
    library_name: str = "LIB"
    strict_reference: bool = False


class LibraryJobs:
    """Composite jobs over a set of contract tables, built on demand.

    ``tables`` offers each contract table as an attribute.
    """

    def __init__(self, spark: SparkSession, tables, settings: Settings):
        configure_session(spark)
        self.spark = spark
        self.t = tables
        self.s = settings

    @cached_property
    def scope(self) -> DataFrame:
        return materialize(orgs.org_descendants(self.t.org_unit, self.s.scope_roots), "scope")

    def active_copies(self, as_of: str | None) -> DataFrame:
        return copies.circulating_copies(
            self.t.copy, self.t.copy_location, self.scope, self.s.excluded_modifiers, as_of
        )

    def trans_copies(self, as_of: str | None) -> DataFrame:
        return copies.circulating_copies(
            self.t.copy, self.t.copy_location, self.scope, self.s.excluded_modifiers, as_of, keep_deleted=True
        )

    def volumes(self) -> DataFrame:
        return copies.volume_display(self.t.call_number, self.t.call_number_prefix, self.t.call_number_suffix)

    def funds(self) -> DataFrame:
        return copies.fund_by_copy(self.t.acq_lineitem_detail, self.t.fund)

    def items(self, as_of: str | None) -> DataFrame:
        return copies.item_table(
            self.active_copies(as_of), self.t.org_unit, self.t.copy_status, self.volumes(),
            copies.isbn_text(self.t.simple_record), self.funds(),
        )

    def circ_stats(self, window_date: str, until: str | None, copy_ids: DataFrame | None = None) -> DataFrame:
        return circ.circ_stats(self.t.circulation, self.t.aged_circulation, window_date, until, copy_ids)

    def items_file(self, historical: bool = False) -> DataFrame:
        """Items with loan statistics; the historical job has no dates and counts all loans three times."""
        as_of = None if historical else self.s.run_date
        scoped = self.active_copies(as_of)
        return circ.items_with_circs(self.items(as_of), self.circ_stats(as_of or HISTORICAL_DATE, as_of, scoped))

    def order_counts(self) -> DataFrame:
        t = self.t
        return orders.order_counts(t.purchase_order, t.acq_lineitem, t.acq_lineitem_detail, t.org_unit, self.scope)

    def hold_items(self, as_of: str | None) -> DataFrame:
        return holds.hold_items(self.trans_copies(as_of), self.t.call_number)

    def resolver(self, as_of: str | None) -> DataFrame:
        return holds.target_resolver(self.hold_items(as_of), self.t.copy_part_map, self.t.metarecord_source_map)

    def open_holds(self) -> DataFrame:
        return holds.scoped_holds(holds.open_holds(self.t.hold_request, self.s.run_date), self.scope, self.t.org_unit)

    def all_holds(self) -> DataFrame:
        return holds.scoped_holds(self.t.hold_request, self.scope, self.t.org_unit)

    def _holds(self, historical: bool) -> tuple[DataFrame, DataFrame]:
        """(folded holds, resolver) of the daily or the historical job."""
        chosen = self.all_holds() if historical else self.open_holds()
        return holds.fold_holds(chosen), self.resolver(None if historical else self.s.run_date)

    def hold_counts(self, historical: bool = False) -> DataFrame:
        return holds.hold_counts(*self._holds(historical), self.t.metarecord_source_map)

    def metarecords(self, historical: bool = False) -> DataFrame:
        return holds.held_metarecords(*self._holds(historical), self.t.metarecord_source_map)

    def transactions(self, historical: bool = False) -> DataFrame:
        """Daily window, or all times."""
        as_of = None if historical else self.s.run_date
        return transactions.transactions(
            self.trans_copies(as_of), self.t.call_number, self.t.circulation, self.t.org_unit, as_of,
            self.s.strict_reference,
        )

    def distinct_bibs(self) -> DataFrame:
        return bibs.distinct_bibs(self.active_copies(None), self.t.call_number)

    def bib_fields(self) -> DataFrame:
        return bibs.bib_fields(self.t.record_entry, self.t.simple_record, self.t.record_attr_flat)

    def upsert(self) -> DataFrame:
        """The next state of the title table that ``bib_extract`` holds."""
        path = fresh_path(self.spark, "bib-table")
        table = BibTable.open_or_create(self.spark, path, bibs.BIB_TABLE_SCHEMA.partition(", ")[2], buckets=16)
        table.load(self.t.bib_extract)
        t = self.t
        table.refresh(self.distinct_bibs(), t.record_entry, t.simple_record, t.record_attr_flat, f"{self.s.run_date} 00:00:00")
        return table.read()

    def branches(self) -> DataFrame:
        t = self.t
        return orgs.branch_file(t.org_unit, t.org_unit_type, t.org_address, t.usr, list(self.s.branch_roots), self.s.lending_date)

    def lending(self) -> DataFrame:
        t = self.t
        return lending.lending(
            t.org_unit, t.org_unit_type, t.copy, t.circulation, t.hold_request, t.call_number, t.simple_record,
            list(self.s.branch_roots), self.s.lending_date,
        )

    @cached_property
    def one_scope(self) -> DataFrame:
        return materialize(orgs.org_descendants(self.t.org_unit, [self.s.collection_root], match_case=True), "scope")

    def collection_items(self) -> DataFrame:
        t = self.t
        return collection.collection_items(
            t.copy, t.copy_location, t.call_number, t.org_unit,
            circ.last_circ(t.circulation, t.aged_circulation, t.org_unit, collection.scoped_copies(t.copy, self.one_scope)),
            t.copy_note, t.full_rec, t.record_entry, self.one_scope,
        )

    def collection_bibs(self) -> DataFrame:
        t = self.t
        return collection.collection_bibs(
            t.record_entry, t.call_number, t.copy, t.simple_record, t.full_rec, self.one_scope
        )

    def item_rows(self) -> DataFrame:
        return collection.collection_item_rows(self.collection_items(), self.s.authority_code, self.s.run_date)

    def bib_rows(self) -> DataFrame:
        return collection.collection_bib_rows(self.collection_bibs(), self.s.service_code, self.s.run_date)

    def ratio(self) -> DataFrame:
        t = self.t
        return ratio.hold_copy_ratio(
            t.hold_request, t.hold_request_record, t.copy, t.copy_location, t.copy_status, t.call_number, t.record_entry
        )

    def koha_items_file(self, historical: bool = False) -> DataFrame:
        t, as_of = self.t, None if historical else self.s.run_date
        return koha.item_table(
            t.koha_items, t.koha_biblioitems, koha.fund_by_item(t.koha_aqorders_items, t.koha_aqorders, t.koha_aqbudgets),
            koha.circ_stats(t.koha_issues, t.koha_old_issues, as_of), as_of, self.s.strict_reference,
        )

    def koha_transactions(self, historical: bool = False) -> DataFrame:
        t = self.t
        if historical:
            return koha.transactions(t.koha_items, t.koha_issues.unionByName(t.koha_old_issues), None, self.s.strict_reference)
        return koha.transactions(t.koha_items, t.koha_issues, self.s.run_date)

    def koha_hold_counts(self, historical: bool = False) -> DataFrame:
        if historical:
            return koha.hold_counts(koha.holds_alltime(self.t.koha_reserves, self.t.koha_old_reserves))
        return koha.hold_counts(koha.open_holds(self.t.koha_reserves, self.s.run_date))

    def report_table(self, name: str) -> DataFrame:
        return self.ratio() if name == "hold_copy_ratio" else getattr(self.t, name)

    def report(self, report: Report, params: Sequence[Any], ordered: bool = False) -> DataFrame:
        return run_report(report, self.report_table, params, ordered)

    # ---- files ------------------------------------------------------------
    @cached_property
    def units(self) -> list[str]:
        """The exported root units; as many as ``scope_roots`` names."""
        return sorted(row["root"] for row in self.scope.select("root").distinct().collect())

    def _write(
        self, outputs: Iterable[tuple[str, tuple[DataFrame, CsvLayout]]], path: str, run_log: str | None
    ) -> dict[str, dict[str, int]]:
        """Write one output after the other; ``{output: {unit: rows}}``, and the same as audit rows of the run."""
        written = {}
        for name, (rows, layout) in outputs:
            if "root" in rows.columns:
                written[name] = sinks.write_unit_files(rows, layout, f"{path}/{name}", self.units)
            else:
                written[name] = {sinks.ALL_UNITS: sinks.write_csv(rows, layout, f"{path}/{name}")}
            if run_log:
                sinks.write_audit(self.spark, run_log, self.s.run_date, name, written[name])
        return written

    def refresh_bib_table(self, path: str, buckets: int = BUCKETS) -> DataFrame:
        """Bring the per-root title table at ``path`` up to date, made on the first run, and return it."""
        table = BibTable.open_or_create(self.spark, path, bibs.BIB_TABLE_SCHEMA, buckets)
        t = self.t
        table.refresh(self.distinct_bibs(), t.record_entry, t.simple_record, t.record_attr_flat, f"{self.s.run_date} 00:00:00")
        return table.read()

    def write_vendor_files(
        self,
        path: str,
        files: Sequence[str] = FILES,
        historical: bool = False,
        run_log: str | None = None,
        bib_table: str | None = None,
    ) -> dict[str, dict[str, int]]:
        """Vendor files, one finished file per scoped root unit; returns the rows of each output and unit.

        ``files`` names what to write: ``hold`` stands for ``holds`` and ``metarecords``, which can be named one by one as
        well.  The ``bib`` file needs ``bib_table``, the path of the title table that the run brings up to date.
        """
        if "bib" in files and bib_table is None:
            raise ValueError("the bib file needs bib_table")
        makers = {
            "item": ("items", lambda: (self.items_file(historical), sinks.ITEMS)),
            "order": ("orders", lambda: (self.order_counts(), sinks.ORDERS)),
            "circ": ("circs", lambda: (sinks.with_days(self.transactions(historical)), sinks.CIRCS)),
            "holds": ("holds", lambda: (self.hold_counts(historical), sinks.HOLDS_ALLTIME if historical else sinks.HOLDS)),
            "metarecords": ("metarecords", lambda: (self.metarecords(historical), sinks.METARECORDS)),
            "bib": ("bibs", lambda: (self.refresh_bib_table(bib_table), sinks.BIBS)),
        }
        chosen = [own for name in files for own in (("holds", "metarecords") if name == "hold" else (name,))]
        return self._write(((makers[name][0], makers[name][1]()) for name in chosen), path, run_log)

    def write_koha_files(self, path: str, historical: bool = False, run_log: str | None = None) -> dict[str, dict[str, int]]:
        t = self.t
        return self._write(
            {
                "items": (self.koha_items_file(historical), sinks.KOHA_ITEMS),
                "orders": (koha.order_counts(t.koha_aqorders, t.koha_reserves), sinks.KOHA_ORDERS),
                "circs": (
                    sinks.with_days(self.koha_transactions(historical)).withColumnRenamed("itemnumber", "ac_id"), sinks.CIRCS
                ),
                "holds": (self.koha_hold_counts(historical), sinks.HOLDS_ALLTIME),
                "bibs": (koha.bibs(t.koha_biblio, t.koha_biblioitems, t.koha_items), sinks.BIBS),
            }.items(),
            path, run_log,
        )

    def write_lending_files(self, path: str) -> None:
        """Branch and lending files with CR LF line ends."""
        for name, lines, header in (
            ("branches", orgs.branch_lines(self.branches()), orgs.BRANCH_HEADER),
            ("lending", lending.lending_lines(self.lending()), lending.LENDING_HEADER),
        ):
            sinks.write_lines(sinks.with_header(lines, header), f"{path}/{name}", line_separator="\r\n")

    def write_collection_file(self, path: str) -> tuple[int, int]:
        return sinks.write_dat(self.bib_rows(), self.item_rows(), self.s.library_name, self.s.run_date, path)

    def marc_fields(self) -> DataFrame:
        return self.t.record_entry.select("id", marc.parse_marc(F.col("marc")).alias("fields"))
