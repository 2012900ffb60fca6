"""Lending, titles, collection rows and files of whole jobs on small tables."""

import glob
import gzip
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfstream.operators import bibs, circulation as circ, collection, koha, lending, newest, ratio
from shelfstream.operators.loan_days import LoanDays
from shelfstream.sources import sinks
from shelfstream.sources.bib_table import BibTable
from shelfstream.workload import jobs

ORG = "id bigint, shortname string, name string, ou_type int, parent_ou bigint"


def lending_inputs(rows):
    return dict(
        org_unit=rows(ORG, (1, "CONS", "c", 1, None), (3, "BR", "b", 3, 1), (4, "XX", "x", 3, 1)),
        org_unit_type=rows("id int, can_have_vols boolean", (1, False), (3, True)),
        copy=rows("id bigint, call_number bigint, circ_lib bigint, status int, deleted boolean",
                  (1, 10, 3, 0, False), (2, 10, 3, 9, False), (3, 10, 3, 0, True), (4, -1, 3, 0, False), (5, 11, 4, 0, False)),
        circulation=rows(
            "id string, target_copy bigint, parent_circ bigint, xact_start timestamp_ntz, checkin_time timestamp_ntz, "
            "xact_finish timestamp_ntz",
            ("a", 1, None, "2020-03-30 00:00:00", None, None), ("b", 1, 7, "2020-03-29 00:00:00", "2020-03-29 10:00:00", None),
            ("c", 1, None, "2019-01-01 00:00:00", "2019-02-01 00:00:00", None), ("d", 2, None, "2020-03-24 00:00:00", None, None)),
        hold_request=rows(
            "id bigint, current_copy bigint, pickup_lib bigint, capture_time timestamp_ntz, fulfillment_time timestamp_ntz",
            *[(i, 1, 3, "2020-03-01 00:00:00", None) for i in (1, 2, 3)], (4, 1, 4, "2020-03-01 00:00:00", None),
            (5, 1, 3, None, None), (6, 1, 3, "2020-03-01 00:00:00", "2020-03-02 00:00:00")),
        call_number=rows("id bigint, record bigint", (10, 100), (11, 100)),
        simple_record=rows("id bigint, isbn array<string>", (100, ["0-306-40615-2", "x", "9780306406157"])),
    )


def test_lending_counts_do_not_fan_out(rows):
    got = {r.branch_code: r for r in lending.lending(**lending_inputs(rows), roots=["CONS"], as_of="2020-03-31").collect()}
    br = got["BR"]
    assert (br.loans, br.renewals, br.holds, br.copies, br.copies_out, br.copies_on_order) == (2, 1, 3, 2, 2, 1)
    assert (br.isbns, br.date_end, br.catalogue_key) == ("9780306406157", "03/31/2020", 100)
    assert got["XX"].copies == 1 and got["XX"].loans == 0


def test_lending_equals_count_distinct_over_the_fan_out(spark, folder):
    j = jobs(spark, folder)
    t = j.t
    copies = t.copy.filter(~F.col("deleted")).select(F.col("id").alias("copy"), "call_number", "circ_lib")
    loans = t.circulation.filter("xact_start > TIMESTAMP_NTZ '1999-06-24'").select("id", F.col("target_copy").alias("copy"))
    waiting = t.hold_request.filter("capture_time IS NOT NULL AND fulfillment_time IS NULL").select(
        F.col("id").alias("hold"), F.col("current_copy").alias("copy"), F.col("pickup_lib").alias("circ_lib"))
    wide = (
        copies.join(loans, "copy", "left").join(waiting, ["copy", "circ_lib"], "left")
        .join(t.call_number.select(F.col("id").alias("call_number"), "record"), "call_number")
        .groupBy("circ_lib", "record")
        .agg(F.count_distinct("id").alias("loans"), F.count_distinct("hold").alias("holds"), F.count_distinct("copy").alias("copies"))
    )
    names = t.org_unit.select(F.col("id").alias("circ_lib"), F.col("shortname").alias("branch_code"))
    expected = {(r.branch_code, r.record): (r.loans, r.holds, r.copies) for r in wide.join(names, "circ_lib").collect()}
    got = {(r.branch_code, r.catalogue_key): (r.loans, r.holds, r.copies) for r in j.lending().collect()}
    assert got and all(expected[key] == value for key, value in got.items())


def test_ratio_divides_by_a_tenth_without_copies(rows):
    schema = "id bigint, cancel_time timestamp_ntz, fulfillment_time timestamp_ntz"
    holds = rows(schema, *[(i, None, None) for i in range(1, 7)], (7, "2020-01-01 00:00:00", None))
    bib_of = rows("id bigint, bib_record bigint", *[(i, 100 if i <= 3 else 200) for i in range(1, 8)])
    copy = rows("id bigint, call_number bigint, location bigint, status int, holdable boolean, deleted boolean",
                (1, 10, 1, 0, True, False), (2, 10, 1, 0, True, False), (3, 10, 1, 3, True, False), (4, 10, 2, 0, True, False),
                (5, 10, 1, 0, True, True), (6, 10, 1, 0, False, False))
    places = rows("id bigint, holdable boolean", (1, True), (2, False))
    states = rows("id int, holdable boolean", (0, True), (3, False))
    acn = rows("id bigint, record bigint", (10, 200))
    entry = rows("id bigint, active boolean", (100, True), (200, True))
    got = {r.id: (r.copy_count, r.hold_count, r.hold_copy_ratio) for r in
           ratio.hold_copy_ratio(holds, bib_of, copy, places, states, acn, entry).collect()}
    assert got == {100: (0, 3, pytest.approx(30.0)), 200: (2, 3, pytest.approx(1.5))}


def bib_tables(rows):
    marc = '<record><datafield tag="245"><subfield code="a">New</subfield></datafield></record>'
    schema = ", ".join(f"{c} string" for c in bibs.BIB_COLUMNS[1:-1])
    old = rows(f"biblio_id bigint, {schema}, last_update timestamp_ntz",
               *[(i, *["old"] * 8, stamp) for i, stamp in ((1, "2020-02-01 00:00:00"), (2, "2020-02-01 00:00:00"), (3, "2020-02-01 00:00:00"), (4, None))])
    entry = rows("id bigint, marc string, deleted boolean, edit_date timestamp_ntz",
                 (1, marc, False, "2020-01-01 00:00:00"), (2, marc, False, "2020-03-01 00:00:00"),
                 (3, marc, True, "2020-01-01 00:00:00"), (4, marc, False, "2020-01-01 00:00:00"), (5, marc, False, "2020-01-01 00:00:00"))
    active = rows("root string, biblio_id bigint", ("R", 1), ("S", 5), ("R", 5))
    simple = rows("id bigint, author string, isbn array<string>", (2, "A", ["1", "2"]))
    attrs = rows("id bigint, attr string, value string", (2, "search_format", "ebook"), (2, "search_format", "book"),
                 (2, "search_format", "book"), (2, "other", "zzz"))
    return old, active, entry, simple, attrs


def test_upsert_deletes_inserts_and_refreshes(rows):
    old, active, entry, simple, attrs = bib_tables(rows)
    assert bibs.update_backlog(old, active, entry).first().backlog == 3
    now = "2020-03-31 00:00:00"
    once = bibs.upsert_bibs(old, active, entry, simple, attrs, now)
    got = {r.biblio_id: (r.title, r.eans, r.material_type) for r in once.collect()}
    assert got == {1: ("old", "old", "old"), 2: ("New", "1,2", "book,book,ebook"), 4: ("New", None, None), 5: ("New", None, None)}
    twice = bibs.upsert_bibs(once, active, entry, simple, attrs, "2021-01-01 00:00:00")
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_first_isbn_is_longest_then_lowest(rows):
    df = rows("record bigint, tag string, subfield string, value string",
              (1, "020", "a", "0306406152 (pbk)"), (1, "020", "z", "9780306406157:x"), (1, "020", "a", "9780306406140"),
              (1, "020", "a", "12345678901234567"), (1, "020", "b", "9999999999999"), (2, "020", "a", "(bad)"), (3, "245", "a", "x"))
    assert {r.biblio_id: r.isbn for r in collection.first_isbn(df).collect()} == {1: "9780306406140", 2: ""}


def test_first_note_is_lowest_id_and_cut(rows):
    df = rows("id bigint, owning_copy bigint, title string, value string",
              (2, 1, "CollectionHQ", "second"), (1, 1, "for collectionhq x", "f" * 150), (0, 1, "other", "no"))
    assert [tuple(r) for r in collection.first_note(df).collect()] == [(1, "f" * 100)]


def test_collection_rows_have_fixed_width(spark, folder):
    j = jobs(spark, folder)
    items = [r.line for r in j.item_rows().collect()]
    titles = [r.line for r in j.bib_rows().collect()]
    assert items and all(line.startswith("##HOLD##,") and ",0 ," in line for line in items)
    assert titles and all(line.startswith("##BIB##,") and "##19980701##" in line for line in titles)
    assert all(len(line.split(",")) >= 25 for line in items)


def test_koha_eans_by_title_or_by_the_known_defect(rows):
    items = rows("ac_id bigint, biblio_id bigint", (1, 10), (10, 1))
    details = rows("biblionumber bigint, isbn string, ean string", (10, "i", "e"), (1, None, "e1"))
    right = {r.ac_id: r.eans for r in koha.join_eans(items, details).collect()}
    strict = {r.ac_id: r.eans for r in koha.join_eans(items, details, strict_reference=True).collect()}
    assert right == {1: "i,e", 10: "e1"} and strict == {1: "e1", 10: "i,e"}


def test_newest_record_list(rows):
    copy = rows("id bigint, call_number bigint, location int, deleted boolean, create_date timestamp_ntz",
                (1, 10, 1, False, "2020-01-01 00:00:00"), (2, 11, 1, False, "2020-02-01 00:00:00"), (3, 12, 2, False, "2020-03-01 00:00:00"),
                (4, 11, 1, True, "2020-09-01 00:00:00"), (5, 13, 1, False, "2019-01-01 00:00:00"))
    acn = rows("id bigint, record bigint", (10, 100), (11, 110), (12, 120), (13, 130))
    assert newest.record_list(newest.newest_items(copy, acn, [1], 2)).first()[0] == "record_list(110,100)"


def read_parts(path, opener=open):
    return "".join(opener(p, "rt", newline="").read() for p in sorted(glob.glob(f"{path}/part-*")))


def test_vendor_files_are_finished_per_unit(spark, folder, tmp_path):
    j = jobs(spark, folder)
    log, table = str(tmp_path / "log"), str(tmp_path / "bibs")

    def run():
        return j.write_vendor_files(str(tmp_path / "out"), ("item", "hold", "bib"), run_log=log, bib_table=table)

    written = run()
    assert set(written) == {"items", "holds", "metarecords", "bibs"} and all(set(units) == {"CONS", "NATION_8"} for units in written.values())
    for name, layout in (("items", sinks.ITEMS), ("holds", sinks.HOLDS), ("metarecords", sinks.METARECORDS), ("bibs", sinks.BIBS)):
        for unit, rows in written[name].items():
            lines = read_parts(tmp_path / "out" / name / f"root={unit}").splitlines()
            assert lines[0] == layout.header and lines.count(layout.header) == 1 and len(lines) == rows + 1
    assert sum(written["bibs"].values()) == j.distinct_bibs().count()
    back = sinks.read_unit_files(spark, str(tmp_path / "out" / "items"))
    assert back.count() == sum(written["items"].values()) + 2

    def audit():
        return sorted((r.event, r.root, r.rows, r.run_date) for r in sinks.read_audit(spark, log).collect())

    expected = sorted((f"{n} file generated", u, k, "1998-07-01") for n, units in written.items() for u, k in units.items())
    assert audit() == expected
    assert run() == written and audit() == expected  # a rerun replaces files and audit rows


def test_a_failed_task_leaves_no_half_file(spark, tmp_path):
    @F.udf("string")
    def broken(k):
        if k == 900:
            raise RuntimeError("task fails")
        return str(k)

    layout = sinks.CsvLayout("a", ("a",), frozenset())
    rows = spark.range(0, 1000, 1, 4).select(F.lit("R").alias("root"), broken("id").alias("a"))
    path = str(tmp_path / "out")
    with pytest.raises(Exception, match="task fails"):
        sinks.write_unit_files(rows, layout, path, ["R"])
    assert not glob.glob(f"{path}/**/part-*", recursive=True)
    good = spark.range(5).select(F.lit("R").alias("root"), F.col("id").cast("string").alias("a"))
    assert sinks.write_unit_files(good, layout, path, ["R", "S"]) == {"R": 5, "S": 0}
    assert read_parts(f"{path}/root=S") == "a\n"
    with pytest.raises(ValueError, match="none of the units"):
        sinks.write_unit_files(good, layout, path, ["S"])


BIB_SCHEMA = bibs.BIB_TABLE_SCHEMA.partition(", ")[2]


def test_bucketed_title_table_follows_the_rules(spark, rows, tmp_path):
    old, active, entry, simple, attrs = bib_tables(rows)
    table = BibTable.open_or_create(spark, str(tmp_path), BIB_SCHEMA, 4)
    assert table.read().count() == 0
    table.load(old)
    now = "2020-03-31 00:00:00"
    table.refresh(active, entry, simple, attrs, now)
    plain = lambda df: sorted(map(str, df.collect()))
    expected = bibs.upsert_bibs(old, active, entry, simple, attrs, now)
    assert plain(table.read()) == plain(expected.select(*table.read().columns))
    assert table.refresh(active, entry, simple, attrs, "2021-01-01 00:00:00") == set()
    # A deleted title with a circulating copy leaves and enters again, as it does without buckets.
    more = active.unionByName(rows("root string, biblio_id bigint", ("R", 3)))
    table.load(old)
    table.refresh(more, entry, simple, attrs, now)
    assert plain(table.read()) == plain(bibs.upsert_bibs(old, more, entry, simple, attrs, now).select(*table.read().columns))


def test_one_percent_of_titles_rewrites_their_buckets_only(spark, tmp_path):
    marc = '<record><datafield tag="245"><subfield code="a">New</subfield></datafield></record>'
    entry = spark.range(1, 401).select("id", F.lit(marc).alias("marc"), (F.col("id") == 7).alias("deleted"),
                                       F.when(F.col("id").isin(11, 250, 399), F.lit("2020-06-01")).otherwise(F.lit("2020-01-01")).cast("timestamp_ntz").alias("edit_date"))
    simple = spark.createDataFrame([], "id bigint, author string, isbn array<string>")
    attrs = spark.createDataFrame([], "id bigint, attr string, value string")
    active = spark.range(1, 402).filter("id <> 7").select(F.lit("R").alias("root"), F.col("id").alias("biblio_id")).filter("biblio_id <> 401")
    table = BibTable.open_or_create(spark, str(tmp_path), bibs.BIB_TABLE_SCHEMA, 128)
    table.load(spark.range(1, 401).select(F.lit("R").alias("root"), F.col("id").alias("biblio_id"), *[F.lit("old").alias(c) for c in bibs.BIB_COLUMNS[1:-1]],
                                          F.lit("2020-03-01").cast("timestamp_ntz").alias("last_update")))
    before = table.state()[1]
    touched = table.refresh(active, entry, simple, attrs, "2020-07-01 00:00:00")
    after = table.state()[1]
    moved = {b for b in before if before[b] != after.get(b)}
    assert moved == touched and 1 <= len(touched) <= 4 < len(before) and table.state()[0] == 2
    got = {r.biblio_id: r.title for r in table.read().collect()}
    assert len(got) == 399 and {k for k, title in got.items() if title == "New"} == {11, 250, 399}
    first = {p.split("/")[-3] for p in glob.glob(f"{tmp_path}/data/*/bucket=*/part-*")}
    table.forget(keep=1)
    assert len(first) == 2 and {r.biblio_id: r.title for r in table.read().collect()} == got
    # A version that was not finished is not read.
    (tmp_path / "versions" / "version=3").mkdir()
    assert table.state()[0] == 2


def test_loan_days_equal_the_full_count_on_ten_days(spark, rows, tmp_path):
    """Ten runs, between which loans come in late, are returned, change their day and go; one run is repeated."""
    rnd = random.Random(8)
    schema = "id bigint, target_copy bigint, xact_start timestamp_ntz, due_date timestamp_ntz, checkin_time timestamp_ntz"
    stamp = lambda d: f"{d} {rnd.randrange(24):02d}:00:00"
    day = lambda k: str(date(2020, 3, 1) + timedelta(k))
    loans = {i: [i, rnd.randrange(6), stamp(day(-rnd.randrange(500))), stamp(day(20)), None] for i in range(60)}
    state = LoanDays(spark, str(tmp_path))

    def tables():
        live = rows(schema, *[tuple(x) for x in loans.values() if x[0] % 3])
        return live, rows(schema, *[tuple(x) for x in loans.values() if x[0] % 3 == 0], (999, 3, None, None, None))

    plain = lambda df: sorted(map(str, df.select("ac_id", "all_circs", "monthly_circs", "annual_circs", "last_checkin", "last_due", "last_circ").collect()))
    state.start(*tables(), day(0))
    for k in range(1, 11):
        touched = set()
        for i in rnd.sample(sorted(loans), 5):
            own = loans[i]
            touched.add(own[2][:10])
            if rnd.random() < 0.3:
                del loans[i]
            elif rnd.random() < 0.5:
                own[4] = stamp(day(k))
            else:
                own[2], own[3] = stamp(day(-rnd.randrange(400))), stamp(day(rnd.randrange(30)))
                touched.add(own[2][:10])
        for n in range(6):
            loans[100 * k + n] = [100 * k + n, rnd.randrange(8), stamp(day(k - 1 + n // 5)), stamp(day(40)), None]
        for _ in range(2 if k == 4 else 1):
            state.advance(*tables(), day(k - 1), day(k), sorted(touched))
        assert plain(state.stats(day(k))) == plain(circ.circ_stats(*tables(), day(k), day(k))), k


def test_loans_out_of_scope_leave_before_the_fold(spark, rows):
    loans = rows("id bigint, target_copy bigint, circ_lib bigint, xact_start timestamp_ntz", *[(i, i % 50, 1, "2020-01-01 00:00:00") for i in range(200)])
    units = rows("id bigint, shortname string", (1, "BR"))
    scoped = circ.last_circ(loans, loans.limit(0), units, rows("id bigint", (3,), (4,)))
    assert sorted((r.ac_id, r.circ_count, r.last_circ_lib) for r in scoped.collect()) == [(3, 4, "BR"), (4, 4, "BR")]
    plan = scoped._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")  # the join feeds the fold


def test_lending_files_end_lines_with_cr_lf(spark, folder, tmp_path):
    jobs(spark, folder).write_lending_files(str(tmp_path))
    text = read_parts(tmp_path / "lending")
    assert text.startswith(lending.LENDING_HEADER + "\r\n") and text.count("\r\n") == text.count("\n")


def test_dat_sections_concatenate(spark, folder, tmp_path):
    bibs_written, items_written = jobs(spark, folder).write_collection_file(str(tmp_path / "dat"))
    text = "".join(read_parts(p, gzip.open) for p in sorted(glob.glob(str(tmp_path / "dat" / "*"))))
    lines = text.splitlines()
    assert lines[0] == "##HEADER##,##DAT##,##19980701##,##LIB##,,,##USA##"
    assert lines[-1] == f"##TRAILER##,{bibs_written},{items_written}"
    assert len(lines) == bibs_written + items_written + 2


def test_second_system_files(spark, folder, tmp_path):
    written = jobs(spark, folder).write_koha_files(str(tmp_path))
    assert set(written) == {"items", "orders", "circs", "holds", "bibs"}
    assert read_parts(tmp_path / "items").splitlines()[0] == sinks.KOHA_ITEMS.header
    assert len(read_parts(tmp_path / "bibs").splitlines()) == written["bibs"][sinks.ALL_UNITS] + 1


def test_historical_vendor_files_take_all_times(spark, folder, tmp_path):
    j = jobs(spark, folder)
    written = j.write_vendor_files(str(tmp_path), ("circ",), historical=True)
    assert sum(written["circs"].values()) > j.transactions().count()
