"""Every operator bound to the supplied test tables: the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfstream.functions import dates, marc, text, thresholds
from shelfstream.operators import (
    bibs, circulation as circ, collection, copies, holds, koha, lending, loan_days, logs, newest, orgs, transactions,
)
from shelfstream.plans.exports import HISTORICAL_DATE, LibraryJobs, Settings
from shelfstream.plans.report_registry import REPORTS
from shelfstream.session import fresh_path
from shelfstream.sources import logs as log_source, sinks
from shelfstream.sources.testbed import RUN_DATE, Testbed
from shelfstream.streaming import alerts

EVENT_DAY = "2024-01-15"
EVENT_NOW = "2024-01-30"
LOCATIONS = (1, 2, 3, 5, 8, 13)
TRACE_SEARCH = "8f14e45fceea167a5a36dedd4bea2543"


SETTINGS = Settings(
    run_date=RUN_DATE,
    scope_roots=("cons", "nation_8"),
    excluded_modifiers=("ECONOMY", "PROMO"),
    branch_roots=("CONS", "NATION_8"),
    lending_date="1999-07-01",
    collection_root="CONS",
)


def jobs(spark: SparkSession, folder: str) -> LibraryJobs:
    return LibraryJobs(spark, Testbed(spark, folder), SETTINGS)


def _strict(j: LibraryJobs) -> LibraryJobs:
    """The same jobs with the original's known slips."""
    return LibraryJobs(j.spark, j.t, replace(j.s, strict_reference=True))


QUERIES: dict[str, Callable[[LibraryJobs], DataFrame]] = {}


def query(function: Callable[[LibraryJobs], DataFrame]) -> Callable[[LibraryJobs], DataFrame]:
    QUERIES[function.__name__] = function
    return function


# ---- sources and sinks ----------------------------------------------------
@query
def src_relational(j):
    return j.t.orders.withColumn("o_orderdate", F.to_date("o_orderdate"))


def _written_service_log(j) -> str:
    """Status lines as text files per day in the shared folder, each line led by its time."""
    path = fresh_path(j.spark, "service-log")
    stamped = F.concat_ws(" ", F.col("ts").cast("string"), "host", "line")
    j.t.service_log.select(F.to_date("ts").alias("day"), stamped.alias("value")).write.partitionBy("day").text(path)
    return path


def _streamed_service_log(spark, path):
    lines = log_source.stream_log_lines(spark, path)
    return lines.select(log_source.stamped_line(F.col("line")).alias("l")).select("l.ts", "l.line")


@query
def src_log_text(j):
    """Daily files written by Spark, then read back as a resumable stream into a table."""
    lines = _streamed_service_log(j.spark, _written_service_log(j))
    out, mark = fresh_path(j.spark, "lines"), fresh_path(j.spark, "lines-checkpoint")
    lines.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(
        availableNow=True
    ).start().awaitTermination()
    stored = j.spark.read.schema("ts timestamp_ntz, line string").parquet(out)
    return stored.groupBy(dates.hour_trunc(F.col("ts")).alias("hour")).agg(F.count(F.lit(1)).alias("lines"))


@query
def sink_csv_protect(j):
    titles = j.t.simple_record
    return titles.select(
        "id",
        text.csv_protect(F.col("title")).alias("title_field"),
        text.csv_protect(F.col("author"), trim=False).alias("author_field"),
    )


def _file(rows, layout):
    return sinks.with_header(sinks.csv_lines(rows, layout), layout.header)


def _unit_files(j, kind, output, historical=False):
    """The finished files of the job, read back with their unit."""
    path = fresh_path(j.spark, "vendor")
    j.write_vendor_files(path, (kind,), historical, bib_table=fresh_path(j.spark, "bib-table"))
    return sinks.read_unit_files(j.spark, f"{path}/{output}")


@query
def sink_items_csv(j):
    return _unit_files(j, "item", "items")


@query
def sink_orders_csv(j):
    return _unit_files(j, "order", "orders")


@query
def sink_circs_csv(j):
    return _unit_files(j, "circ", "circs")


@query
def sink_bibs_csv(j):
    return _unit_files(j, "bib", "bibs")


@query
def sink_holds_csv(j):
    return _unit_files(j, "holds", "holds")


@query
def sink_holds_alltime_csv(j):
    return _unit_files(j, "holds", "holds", historical=True)


@query
def sink_metarecords_csv(j):
    return _unit_files(j, "metarecords", "metarecords")


@query
def sink_branch_csv(j):
    return sinks.with_header(orgs.branch_lines(j.branches()), orgs.BRANCH_HEADER)


@query
def sink_lending_csv(j):
    return sinks.with_header(lending.lending_lines(j.lending()), lending.LENDING_HEADER)


@query
def sink_koha_items_csv(j):
    return _file(j.koha_items_file(), sinks.KOHA_ITEMS)


@query
def sink_koha_bibs_csv(j):
    return _file(koha.bibs(j.t.koha_biblio, j.t.koha_biblioitems, j.t.koha_items), sinks.BIBS)


@query
def sink_hash_delimited(j):
    return j.t.copy.select("id", text.hash_quote(F.col("dummy_title")).alias("quoted_title"),
                           text.hash_quote(F.col("status")).alias("quoted_status"))


@query
def sink_dat_file(j):
    return collection.dat_lines(j.bib_rows(), j.item_rows(), "LIB", RUN_DATE)


@query
def run_audit(j):
    """Two outputs are written, one of them by a repeated run; the audit has one row per output and unit."""
    path, log = fresh_path(j.spark, "vendor"), fresh_path(j.spark, "run-log")
    for files in (("order", "holds"), ("order",)):
        j.write_vendor_files(path, files, run_log=log)
    return sinks.read_audit(j.spark, log).select("run_date", "event", "root", "rows")


# ---- job arguments --------------------------------------------------------
@query
def exclude_modifiers(j):
    return copies.exclude_modifiers(j.t.copy, SETTINGS.excluded_modifiers).select("id", "circ_modifier")


@query
def scope_orgs(j):
    units = j.scope.select("root", F.col("org_id").alias("circ_lib"))
    return j.t.copy.join(units, "circ_lib").groupBy("root").agg(F.count("id").alias("copies"))


@query
def as_of(j):
    return j.t.copy.filter(copies.before_day("create_date", "1996-03-15")).select("id")


# ---- scans, filters, projections -------------------------------------------
def _copy_ids(df):
    return df.select("root", "id", "barcode", "location_name")


@query
def filter_active_copies(j):
    return _copy_ids(j.active_copies(RUN_DATE))


@query
def filter_trans_copies(j):
    return _copy_ids(j.trans_copies(RUN_DATE))


@query
def filter_active_copies_alltime(j):
    return _copy_ids(j.active_copies(None))


@query
def koha_items(j):
    return koha.items(j.t.koha_items, RUN_DATE)


@query
def filter_open_holds_asof(j):
    return j.open_holds().select("root", "id", "hold_type", "target", "holds_branch", "current_copy")


@query
def filter_holds_alltime(j):
    return j.all_holds().select("root", "id", "hold_type", "target", "holds_branch", "current_copy")


@query
def koha_open_holds_asof(j):
    return koha.open_holds(j.t.koha_reserves, RUN_DATE)


@query
def koha_open_holds_alltime(j):
    return koha.holds_alltime(j.t.koha_reserves, j.t.koha_old_reserves)


@query
def case_status_name(j):
    return j.t.copy.select("id", "status", copies.status_label(F.col("status")).alias("label")).filter("label IS NOT NULL")


@query
def case_renewal(j):
    return transactions.loan_events(j.t.circulation, RUN_DATE).filter("transaction_type <> 'checkin'").groupBy(
        "transaction_type"
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def call_number_display(j):
    return j.volumes()


@query
def address_concat(j):
    return orgs.first_address(j.t.org_address).select("org_unit", "address")


# ---- joins ------------------------------------------------------------------
@query
def join_items_dims(j):
    return copies.item_dimensions(j.active_copies(RUN_DATE), j.t.org_unit, j.t.copy_status).select(
        "root", "id", "location_name", "library", "status_name"
    )


@query
def join_volume(j):
    return j.active_copies(RUN_DATE).join(j.volumes(), "call_number", "left").select("root", "id", "biblio_id", "call_number_text")


@query
def join_fund(j):
    return j.active_copies(RUN_DATE).select("root", F.col("id").alias("ac_id")).join(j.funds(), "ac_id", "left")


@query
def join_isbn_array(j):
    titles = copies.isbn_text(j.t.simple_record)
    return j.hold_items(RUN_DATE).join(titles, "biblio_id", "left").select("root", "ac_id", "biblio_id", "eans")


@query
def koha_join_eans(j):
    return koha.join_eans(koha.items(j.t.koha_items, RUN_DATE), j.t.koha_biblioitems).select("ac_id", "biblio_id", "eans")


@query
def koha_join_eans_strict(j):
    rows = koha.join_eans(koha.items(j.t.koha_items, RUN_DATE), j.t.koha_biblioitems, strict_reference=True)
    return rows.select("ac_id", "biblio_id", "eans")


@query
def semi_in_items(j):
    items = j.active_copies(RUN_DATE).select(F.col("id").alias("ac_id"))
    return circ.in_items(j.circ_stats(RUN_DATE, RUN_DATE), items).select("ac_id", "all_circs")


@query
def semi_title_holds(j):
    titles = j.hold_items(RUN_DATE).select("root", F.col("biblio_id").alias("target")).distinct()
    return j.open_holds().filter("hold_type = 'T'").join(titles, ["root", "target"], "left_semi").select(
        "root", "id", "target"
    )


@query
def semi_metarecords(j):
    return j.metarecords()


@query
def anti_missing_bibs(j):
    return bibs.missing_bibs(j.distinct_bibs(), j.t.bib_extract)


@query
def anti_deleted_bibs(j):
    return bibs.without_deleted(j.t.bib_extract, j.t.record_entry).select("biblio_id", "title")


@query
def anti_invalid_metarecord(j):
    known = j.t.metarecord_source_map.select(F.col("metarecord").alias("target"))
    grouped = j.open_holds().filter("hold_type = 'M'")
    return grouped.join(known, "target", "left_anti").select("root", "id", "target")


@query
def left_items_circs(j):
    return j.items_file()


@query
def join_copy_circ_org(j):
    loans = j.transactions().filter(F.col("transaction_type").isin("circ", "renewal", "checkin"))
    return loans.select("root", "ac_id", "transaction_type", "transaction_branch", "biblio_id")


@query
def join_holds_resolve(j):
    resolved = holds.resolve_targets(j.open_holds(), j.resolver(RUN_DATE), j.t.metarecord_source_map)
    return resolved.select("root", "id", "hold_type", "target", "biblio_id", "holds_branch")


@query
def lending_multi_left(j):
    return j.lending()


@query
def join_org_type(j):
    units = orgs.volume_owning(j.t.org_unit, j.t.org_unit_type).select(F.col("id").alias("org_id"), "shortname")
    return orgs.org_descendants(j.t.org_unit, SETTINGS.branch_roots, match_case=True).join(units, "org_id").select("root", "shortname")


@query
def join_transit_arrival(j):
    return circ.arrivals(j.t.transit_copy, j.t.copy)


@query
def range_after_arrival(j):
    return circ.loans_after_arrival(j.t.circulation, circ.arrivals(j.t.transit_copy, j.t.copy)).select(
        "ac_id", "uses_since_arrival"
    )


@query
def last_circ_lib(j):
    return circ.last_circ(j.t.circulation, j.t.aged_circulation, j.t.org_unit).select("ac_id", "last_circ_lib")


@query
def lookup_hold_copy_ratio(j):
    titles = j.t.simple_record.select("id", "title")
    return j.ratio().join(titles, "id", "left").select("id", "title", "hold_copy_ratio")


# ---- aggregations -----------------------------------------------------------
@query
def agg_circs_all(j):
    return j.circ_stats(RUN_DATE, RUN_DATE).select("ac_id", "all_circs")


@query
def agg_circs_monthly(j):
    return j.circ_stats(RUN_DATE, RUN_DATE).select("ac_id", "monthly_circs")


@query
def agg_circs_annual(j):
    return j.circ_stats(RUN_DATE, RUN_DATE).select("ac_id", "annual_circs")


@query
def agg_last_checkin(j):
    return j.circ_stats(RUN_DATE, RUN_DATE).select("ac_id", "last_checkin")


@query
def agg_last_due(j):
    return j.circ_stats(RUN_DATE, RUN_DATE).select("ac_id", "last_due")


@query
def agg_last_circ(j):
    return j.circ_stats(RUN_DATE, RUN_DATE).select("ac_id", "last_circ")


def _three_runs(j):
    """Loan statistics kept up over three runs, with days touched in between."""
    state = loan_days.LoanDays(j.spark, fresh_path(j.spark, "loan-days"))
    live, aged = j.t.circulation, j.t.aged_circulation
    # What the first run cannot know yet: loans of its last days, and returns after it.
    early = [t.filter("xact_start < TIMESTAMP_NTZ '1998-03-01'").withColumn(
        "checkin_time", F.when(F.col("checkin_time") < F.lit("1998-02-20").cast("timestamp_ntz"), F.col("checkin_time"))) for t in (live, aged)]
    state.start(*early, "1998-03-01")
    late = early[0].unionByName(early[1], allowMissingColumns=True).select("id", F.col("checkin_time").alias("was")).join(
        live.select("id", "xact_start", "checkin_time").unionByName(aged.select("id", "xact_start", "checkin_time")), "id")
    days = late.filter("NOT was <=> checkin_time").select(F.to_date("xact_start").cast("string").alias("day")).distinct()
    state.advance(live, aged, "1998-03-01", "1998-06-01", [r["day"] for r in days.collect()])  # at most the days of the calendar
    state.advance(live, aged, "1998-06-01", RUN_DATE, [])
    return state.stats(RUN_DATE)


@query
def agg_circs_incremental(j):
    return _three_runs(j)


@query
def agg_circs_alltime_koha(j):
    return koha.circ_stats(j.t.koha_issues, j.t.koha_old_issues, None)


@query
def koha_agg_circs(j):
    return koha.circ_stats(j.t.koha_issues, j.t.koha_old_issues, RUN_DATE)


@query
def agg_circs_hist_quirk(j):
    return j.circ_stats(HISTORICAL_DATE, None)


@query
def agg_orders(j):
    return j.order_counts()


@query
def koha_agg_orders(j):
    return koha.order_counts(j.t.koha_aqorders, j.t.koha_reserves)


@query
def agg_holds_count(j):
    return j.hold_counts()


@query
def koha_agg_holds(j):
    return j.koha_hold_counts()


@query
def agg_distinct_bibs(j):
    return j.distinct_bibs()


@query
def agg_patrons(j):
    return orgs.agg_patrons(j.t.usr)


@query
def agg_lending(j):
    return j.lending().select("branch_code", "catalogue_key", *lending.COUNTS)


@query
def agg_arrival(j):
    return circ.arrivals(j.t.transit_copy, j.t.copy).select("ac_id", F.to_date("arrived").alias("arrived_on"))


@query
def agg_circ_count(j):
    counts = circ.last_circ(j.t.circulation, j.t.aged_circulation, j.t.org_unit)
    return j.t.copy.select(F.col("id").alias("ac_id")).join(counts, "ac_id", "left").select(
        "ac_id", F.coalesce(F.col("circ_count"), F.lit(0)).cast("string").alias("use_total")
    )


@query
def agg_material_types(j):
    return bibs.material_types(j.t.record_attr_flat).select(
        "biblio_id", F.array_join("material_type", ",").alias("material_type")
    )


@query
def agg_subject_string(j):
    return j.marc_fields().select(
        "id",
        marc.subject_string(F.col("fields"), "650", text.naco_normalize).alias("subject"),
        marc.subject_string(F.col("fields"), "655", text.naco_normalize).alias("genre"),
    )


@query
def agg_hold_copy_ratio(j):
    return j.ratio()


@query
def agg_update_backlog(j):
    return bibs.update_backlog(j.t.bib_extract, j.distinct_bibs(), j.t.record_entry)


# ---- top-k, latest, windows ---------------------------------------------------
@query
def latest_per_copy(j):
    return circ.last_circ(j.t.circulation, j.t.aged_circulation, j.t.org_unit).select("ac_id", "last_circ_lib", "last_use")


@query
def first_note(j):
    return collection.first_note(j.t.copy_note)


@query
def first_isbn(j):
    return collection.first_isbn(j.t.full_rec)


@query
def first_address(j):
    return orgs.first_address(j.t.org_address)


@query
def any_item_type(j):
    return collection.any_item_type(j.t.copy, j.t.call_number)


@query
def ordered_items(j):
    scope = j.one_scope.select(F.col("org_id").alias("circ_lib"))
    return j.t.copy.filter(~F.col("deleted")).join(scope, "circ_lib", "left_semi").select("id", "barcode").orderBy("id")


@query
def newest_items_topn(j):
    return newest.newest_items(j.t.copy, j.t.call_number, LOCATIONS, 10)


@query
def newest_record_list(j):
    return newest.record_list(newest.newest_items(j.t.copy, j.t.call_number, LOCATIONS, 10))


@query
def feed_record_ids(j):
    entry = F.concat(F.lit('<id>tag:biblio-record_entry/'), F.col("page_id").cast("string"), F.lit("</id>"))
    feed = j.t.pages.select("page_id", F.concat(entry, F.col("html"), entry).alias("feed"))
    return newest.feed_record_ids(feed, "feed").select("page_id", "record_ids")


@query
def top_server(j):
    return logs.top_server(j.t.app_log, "Returning NULL")


@query
def oldest_query(j):
    return logs.oldest_query(j.t.activity).select("current_query", "database")


@query
def sample_delta(j):
    return logs.sample_delta(j.t.cpu_sample, ["cpu_user", "cpu_idle"]).select(
        "host", "sample_no", "d_cpu_user", "d_cpu_idle"
    )


# ---- set operations and mutation ----------------------------------------------
@query
def union_current_aged(j):
    return circ.all_circulations(j.t.circulation, j.t.aged_circulation).groupBy("is_live", "circ_lib").agg(
        F.count("id").alias("loans")
    )


def _transaction_rows(df):
    return sinks.with_days(df).select(
        "root", "ac_id", "barcode", "biblio_id", "transaction_type", "transaction_day", "transaction_branch", "due_day"
    )


@query
def transactions_union(j):
    return _transaction_rows(j.transactions())


@query
def transactions_alltime(j):
    return _transaction_rows(_strict(j).transactions(historical=True))


@query
def transactions_alltime_corrected(j):
    return _transaction_rows(j.transactions(historical=True))


def _koha_transaction_rows(df):
    return sinks.with_days(df).select(
        "itemnumber", "barcode", "biblio_id", "transaction_type", "transaction_day", "transaction_branch", "due_day"
    )


@query
def koha_transactions(j):
    return _koha_transaction_rows(j.koha_transactions())


@query
def koha_transactions_alltime(j):
    return _koha_transaction_rows(_strict(j).koha_transactions(historical=True))


@query
def koha_transactions_alltime_corrected(j):
    return _koha_transaction_rows(j.koha_transactions(historical=True))


@query
def uniq_list(j):
    trimmed = F.transform("isbn", lambda v: F.trim(v))
    return j.t.simple_record.select("id", F.array_join(text.uniq_list(trimmed), ";").alias("unique_isbns"))


@query
def upsert_bibs(j):
    return j.upsert().withColumn("last_update", F.to_date("last_update"))


# ---- scalar rules over tables -----------------------------------------------
@query
def attempt_year(j):
    value = marc.first_value(F.col("fields"), ("260", "264"), "c")
    return j.marc_fields().select("id", text.attempt_year(value).alias("year"))


@query
def attempt_price(j):
    value = marc.first_field_value(F.col("fields"), "020", "c")
    return j.marc_fields().select("id", text.attempt_price(value).alias("price"))


@query
def price_fallback(j):
    return j.collection_items().select("ac_id", "price")


@query
def attempt_isbn(j):
    return collection.first_isbn(j.t.full_rec).select("biblio_id", F.length("isbn").cast("bigint").alias("isbn_length"), "isbn")


@query
def norm_isbn(j):
    values = j.t.simple_record.select("id", F.explode("isbn").alias("raw"))
    return values.select("id", "raw", text.norm_isbn(F.col("raw")).alias("isbn13"))


@query
def extract_isbns(j):
    return lending.isbn_normalize(j.t.simple_record)


@query
def isbn_normalize(j):
    """Canonical distinct ISBN-13 per title, one row each."""
    rows = j.t.simple_record.select("id", F.explode(F.array_distinct(F.transform("isbn", text.norm_isbn))).alias("isbn13"))
    return rows.filter("isbn13 IS NOT NULL")


@query
def price_year_clean(j):
    marc_part = j.marc_fields().select(
        F.col("id").alias("record"),
        text.attempt_year(marc.first_field_value(F.col("fields"), "260", "c")).alias("year"),
        text.attempt_price(marc.first_field_value(F.col("fields"), "020", "c")).alias("title_price"),
    )
    own = j.t.copy.join(j.t.call_number.select(F.col("id").alias("call_number"), "record"), "call_number")
    return own.join(marc_part, "record", "left").select(
        "id", "year",
        text.price_fallback(text.attempt_price(F.col("price").cast("string")), F.col("title_price")).alias("price_cents"),
    )


@query
def bib_fields(j):
    return j.bib_fields()


@query
def marc_title(j):
    return j.marc_fields().select("id", marc.marc_title(F.col("fields")).alias("title"))


@query
def marc_arrays(j):
    fields = F.col("fields")

    def joined(tags, code):
        return F.array_join(marc.marc_one_element(fields, tags, code), ",")

    return j.marc_fields().select(
        "id", joined(("490",), "a").alias("series"), joined(("260", "264"), "c").alias("pub_date"),
        joined(("260", "264"), "b").alias("publisher"), joined(("020", "024"), "c").alias("price"),
    )


@query
def marc_first(j):
    fields = F.col("fields")
    return j.marc_fields().select(
        "id", *[
            marc.first_field_value(fields, tag, code).alias(f"f{tag}{code}")
            for tag, code in (("250", "a"), ("260", "c"), ("260", "b"), ("020", "c"), ("082", "a"))
        ],
    )


@query
def naco_normalize(j):
    return j.marc_fields().select(
        "id", text.naco_normalize(marc.first_field_value(F.col("fields"), "250", "a")).alias("edition")
    )


@query
def substr_caps(j):
    return j.collection_bibs().select("biblio_id", "title", "author", "edition", "publisher", "class_num")


@query
def yyyymmdd(j):
    return j.t.copy.select("id", dates.yyyymmdd(F.col("create_date")).alias("added"))


@query
def floating_flag(j):
    return j.t.copy.select("id", F.when(F.col("floating") > 0, "Y").alias("rotating"))


@query
def isbn_ean_concat(j):
    return koha.isbn_ean(j.t.koha_biblioitems)


@query
def koha_status_case(j):
    return j.t.koha_items.select("itemnumber", koha.status_case(F.col("itemlost")).alias("status"))


@query
def koha_bibs(j):
    return koha.bibs(j.t.koha_biblio, j.t.koha_biblioitems, j.t.koha_items)


@query
def date_parts(j):
    start = F.col("xact_start")
    return j.t.circulation.select(
        "id", *[dates.date_part(p, start).alias(p) for p in ("date", "month_trunc", "year_trunc", "hour_trunc", "hod", "day_name")]
    )


@query
def format_mmddyyyy(j):
    return j.t.orders.select("o_orderkey", dates.format_mmddyyyy(F.col("o_orderdate")).alias("day"))


@query
def regex_log_fields(j):
    return logs.regex_log_fields(j.t.app_log).select("line_no", "pid", "auth", "trace")


# ---- logs and metrics -----------------------------------------------------------
@query
def parse_service_health(j):
    return logs.service_health(j.t.service_log).select("line_no", "drone_pct", "severity")


@query
def stream_service_health(j):
    lines = _streamed_service_log(j.spark, _written_service_log(j))
    out = fresh_path(j.spark, "health")
    alerts.stream_service_health(lines, out, fresh_path(j.spark, "health-checkpoint")).awaitTermination()
    scored = j.spark.read.schema("ts timestamp_ntz, line string, drone_pct bigint, severity int").parquet(out)
    return logs.health_per_hour(scored)


@query
def stream_window_alert(j):
    """Windowed counts of a parquet stream, open windows included."""
    source = fresh_path(j.spark, "app-log")
    j.t.app_log.select("ts", "line").repartitionByRange("ts").write.parquet(source)
    lines = j.spark.readStream.schema("ts timestamp_ntz, line string").parquet(source)
    lines = lines.withColumn("ts", F.timestamp_seconds(dates.epoch_seconds(F.col("ts"))))
    out = fresh_path(j.spark, "windows")
    alerts.stream_window_counts(
        lines, "Returning NULL", 60, "1 hour", out, fresh_path(j.spark, "windows-checkpoint")
    ).awaitTermination()
    return alerts.window_counts(j.spark, out, 2, 4).select(
        dates.from_epoch_seconds(F.unix_seconds("window_start")).alias("window_start"), "n", "severity"
    )


@query
def missing_log_warn(j):
    """The log ends within the range, so its last days are missing."""
    return logs.missing_hours(j.t.service_log, "2024-01-01 00:00:00", "2024-02-03 23:00:00")


@query
def service_counts(j):
    return logs.service_counts(j.t.process_list, j.t.service_config)


@query
def cpu_shares(j):
    return logs.cpu_shares(j.t.cpu_sample)


@query
def ram_shares(j):
    return logs.ram_shares(j.t.ram_sample)


@query
def window_count_alert(j):
    return logs.window_count_alert(j.t.app_log, "Returning NULL", 15, 2, 4)


@query
def recent_count_alert(j):
    return logs.recent_count_alert(j.t.app_log, "Returning NULL", "2024-01-15 12:30:45", 1440, 20, 40)


@query
def hour_count_alert(j):
    return logs.window_count_alert(j.t.app_log, "IS NOT CONNECTED TO THE NETWORK", 60, 3, 6)


@query
def failed_trigger_events(j):
    return logs.failed_trigger_events(j.t.trigger_event, j.t.event_definition, EVENT_DAY)


@query
def pending_backlog(j):
    return logs.pending_backlog(j.t.trigger_event)


@query
def replication_lag(j):
    return logs.replication_lag(j.t.replication_status)


@query
def long_query(j):
    return logs.long_query(j.t.activity, EVENT_NOW)


@query
def classify(j):
    value, users = F.col("value"), F.col("user_id").cast("double")
    return j.t.events.select(
        "event_id",
        thresholds.classify(value, 300, 400).alias("high"),
        thresholds.classify(value, 50, 10, low_is_bad=True).alias("low"),
        thresholds.classify_band(value, 490.0).alias("band"),
        thresholds.classify_memory(value, F.lit(490.0), users * 4).alias("memory"),
        thresholds.severity_name(thresholds.classify(value, 300, 400)).alias("high_name"),
    )


@query
def trace_related_lines(j):
    return logs.trace_related_lines(
        j.t.app_log, TRACE_SEARCH, follow_auth=True, follow_trace=True
    ).select("line_no")


# ---- composite jobs ----------------------------------------------------------------
@query
def chq_item_rows(j):
    return j.item_rows()


@query
def chq_bib_rows(j):
    return j.bib_rows()


@query
def org_descendants(j):
    return j.scope


@query
def org_lookup(j):
    return orgs.org_lookup(j.t.org_unit, j.t.org_address)


@query
def branch_file(j):
    return j.branches()


# ---- reports ---------------------------------------------------------------------
DAYS = (date(1996, 1, 1), date(1999, 12, 31))
EVENT_DAYS = (date(2024, 1, 3), date(2024, 1, 25))
MONTHS = (date(1996, 1, 1), date(1999, 12, 1))
MONTH_LIST = [date(1997, 3, 1), date(1998, 3, 1), date(1999, 3, 1)]
YEAR = date(1998, 1, 1)
MODIFIERS = ["LARGE", "MEDIUM", "STANDARD", "SMALL"]
PLACES = list(range(1, 21))
GROUPS = [1, 2, 4]
LABELS = ("b", "s")
ALL_UNITS = "all org units"

REPORT_PARAMETERS: dict[str, tuple] = {
    "rpt_brief_inventory_list": (LABELS, ALL_UNITS, PLACES),
    "rpt_detailed_inventory_list": (LABELS, ALL_UNITS, PLACES),
    "rpt_list_pre_cats": (ALL_UNITS,),
    "rpt_list_titles_by_circulation_modifier": (ALL_UNITS, MODIFIERS),
    "rpt_list_titles_by_physical_format_item_type": (ALL_UNITS, MODIFIERS, ["a", "g", "t"]),
    "rpt_list_of_titles_deleted_by_date_range": ((date(1998, 1, 1), date(1998, 11, 30)),),
    "rpt_list_items_by_copy_status": (ALL_UNITS, [3, 4, 13, 14]),
    "rpt_list_items_added_by_date_range": ((date(1990, 6, 1), date(1994, 12, 31)), ALL_UNITS),
    "rpt_count_items_by_circulation_modifier_shelving_location":
        ((date(1990, 6, 1), date(1999, 12, 31)), PLACES, MODIFIERS, ALL_UNITS),
    "rpt_count_items_added_by_date_range_statistical_category": ((date(1990, 6, 1), date(1999, 12, 31)), ALL_UNITS, [0, 1, 3]),
    "rpt_count_items_deleted_by_date_range": (ALL_UNITS, (date(1998, 1, 1), date(1998, 11, 30))),
    "rpt_count_items_added_by_date_range": ((date(1990, 6, 1), date(1999, 12, 31)), ALL_UNITS),
    "rpt_count_items_by_library": (ALL_UNITS,),
    "rpt_count_titles_by_library": (ALL_UNITS,),
    "rpt_count_inactive_patron_accounts_by_library": (ALL_UNITS,),
    "rpt_patron_mailing_list": (ALL_UNITS,),
    "rpt_list_patrons_with_open_transactions_by_permission_group": (DAYS, ALL_UNITS, GROUPS),
    "rpt_list_patrons_with_open_transactions": (DAYS, ALL_UNITS),
    "rpt_list_patrons_with_outstanding_balances_by_permission_group": (ALL_UNITS, GROUPS),
    "rpt_list_patrons_with_outstanding_balances": (ALL_UNITS,),
    "rpt_count_patrons_by_permission_group": ((date(1995, 6, 1), date(1999, 12, 31)), GROUPS, ALL_UNITS),
    "rpt_count_patrons_by_library_statistical_category": (ALL_UNITS, [0, 2, 3]),
    "rpt_count_patrons_added_by_zip_code_date": ((date(1995, 6, 1), date(1999, 12, 31)), ALL_UNITS),
    "rpt_count_patrons_added_by_date_range": ((date(1995, 6, 1), date(1999, 12, 31)), ALL_UNITS),
    "rpt_list_titles_used_in_house": (EVENT_DAYS, ALL_UNITS),
    "rpt_count_in_house_usage_by_library": (EVENT_DAYS, ALL_UNITS),
    "rpt_open_pre_cat_circulations": (DAYS, ALL_UNITS),
    "rpt_list_available_holds_by_capture_date_clean_holds_shelf": (ALL_UNITS, DAYS),
    "rpt_items_loaned_by_receiving_library_date_range": (DAYS, ALL_UNITS),
    "rpt_items_loaned_by_sending_library_date_range": (DAYS, ALL_UNITS),
    "rpt_count_holds_unfulfilled_by_library": (ALL_UNITS, DAYS),
    "rpt_count_holds_filled_by_library_date_range": (ALL_UNITS, DAYS),
    "rpt_count_circulations_by_non_cataloged_type_date_range": (ALL_UNITS, EVENT_DAYS, [0, 1, 2, 4]),
    "rpt_count_circulations_by_patron_permission_group": (ALL_UNITS, DAYS, GROUPS),
    "rpt_count_circulations_by_library_shelving_location": (MONTHS, ALL_UNITS, PLACES),
    "rpt_count_circulations_by_library_circulation_modifier": (MONTHS, ALL_UNITS, MODIFIERS),
    "rpt_count_circulations_by_hour_of_the_day": (DAYS, ALL_UNITS),
    "rpt_count_circulation_by_library_day_of_the_week": (ALL_UNITS, DAYS),
    "rpt_hourly_checkouts": (DAYS, ALL_UNITS),
    "rpt_hourly_checkins": (DAYS, ALL_UNITS),
    "rpt_checkout_statistics_by_circulating_library": (MONTH_LIST, ALL_UNITS),
    "rpt_circulation_placed_holds_by_patron_group_report": (MONTH_LIST, GROUPS),
    "rpt_checkins_yearly": (YEAR, ALL_UNITS),
    "rpt_circulation_yearly": (YEAR, ALL_UNITS),
    "rpt_checkin_statistics": (MONTH_LIST, ALL_UNITS),
    "rpt_opac_renewal_statistics": (MONTH_LIST,),
    "rpt_checkout_statistics_by_circulation_type": (MONTH_LIST, ALL_UNITS),
    "rpt_checkout_statistics": (MONTH_LIST, ALL_UNITS),
    "rpt_holds_filled_report_by_fulfillment_date_pickup_library": (DAYS, ALL_UNITS),
    "rpt_circulation_statistics_by_patron_address": (DAYS, ALL_UNITS),
    "rpt_placed_holds_by_patron_group_and_requesting_library": (MONTH_LIST, GROUPS),
    "rpt_purchase_alerts_report": (3.0, LABELS),
    "rpt_popular_titles_on_hold": (3.0,),
    "rpt_size_of_collection_report": (DAYS, ALL_UNITS),
    "rpt_ytd_circs_by_owning_library_and_shelving_location": ((date(1998, 1, 1), date(1998, 7, 1)), ALL_UNITS),
    "rpt_new_purchase_alerts_report": (LABELS, 3.0),
    "rpt_new_popular_titles_on_hold": (3.0,),
}


def _report_query(key: str) -> Callable[[LibraryJobs], DataFrame]:
    def build(j: LibraryJobs) -> DataFrame:
        units = j.t.org_unit.select("id")
        params = [units if p is ALL_UNITS else p for p in REPORT_PARAMETERS[key]]
        return j.report(REPORTS[key], params)

    return build


for _key in REPORTS:
    QUERIES[_key] = _report_query(_key)


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so results compare across engines."""
    decimals = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    if not decimals:
        return df
    return df.select(*[F.col(c).cast("double").alias(c) if c in decimals else F.col(c) for c in df.columns])


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function):
        return lambda spark, folder: plain_types(function(jobs(spark, folder)))

    return {name: bind(function) for name, function in QUERIES.items()}
