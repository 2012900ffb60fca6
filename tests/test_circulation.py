from shelfstream.operators import circulation as circ, copies, holds, orders, orgs, transactions

CIRC = "id string, target_copy bigint, circ_lib bigint, parent_circ bigint, xact_start timestamp_ntz, " \
       "due_date timestamp_ntz, checkin_time timestamp_ntz"
COPY = "id bigint, barcode string, call_number bigint, circ_lib bigint, location bigint, status int, circ_modifier string, " \
       "circulate boolean, deleted boolean, create_date timestamp_ntz, edit_date timestamp_ntz"
D = "2020-03-31"


def copy(id, modifier="BOOK", deleted=False, status=0, edit="2000-01-01 00:00:00", lib=3, acn=None, circulate=True, location=1):
    return (id, f"b{id}", id if acn is None else acn, lib, location, status, modifier, circulate, deleted,
            "2019-01-01 00:00:00", edit)


def loan(id, start, copy=1, lib=3, parent=None, checkin=None):
    return (id, copy, lib, parent, start, "2020-05-01 00:00:00", checkin)


def library(rows):
    return {
        "scope": rows("root string, org_id bigint", ("R", 3)),
        "location": rows("id bigint, name string, circulate boolean", (1, "stacks", True), (2, "closed", False)),
        "org": rows("id bigint, shortname string", (3, "BR"), (4, "XX")),
        "acn": rows("id bigint, record bigint", (1, 11), (2, 12), (3, 13)),
    }


def test_null_modifier_is_dropped_even_without_exclusions(rows):
    lib = library(rows)
    df = rows(COPY, copy(1), copy(2, None), copy(3, "DVD"), copy(4, deleted=True), copy(5, circulate=False), copy(6, location=2))
    ids = lambda out: sorted(r.id for r in out.collect())
    assert ids(copies.circulating_copies(df, lib["location"], lib["scope"], None, D)) == [1, 3]
    assert ids(copies.circulating_copies(df, lib["location"], lib["scope"], ["DVD"], D, keep_deleted=True)) == [1, 4]
    assert ids(copies.circulating_copies(df, lib["location"], lib["scope"], None, "2019-01-01")) == []


def test_transaction_window_is_open_at_both_ends(rows):
    lib = library(rows)
    held = copies.circulating_copies(rows(COPY, copy(1)), lib["location"], lib["scope"], None, D)
    loans = rows(
        CIRC, loan("a", "2020-03-30 00:00:00"), loan("b", "2020-03-30 00:00:01", parent=7),
        loan("c", "2020-03-30 23:59:59.999999"), loan("d", "2020-03-31 00:00:00"),
        loan("e", "2019-01-01 00:00:00", checkin="2020-03-30 10:00:00", lib=4),
    )
    out = transactions.transactions(held, lib["acn"], loans, lib["org"], D).collect()
    assert sorted((r.transaction_type, r.transaction_branch, r.biblio_id) for r in out) == [
        ("checkin", "XX", 11), ("circ", "BR", 11), ("renewal", "BR", 11),
    ]


def test_deletions_and_status_changes(rows):
    lib = library(rows)
    df = rows(
        COPY, copy(1, deleted=True, status=3, edit="2020-03-30 12:00:00"), copy(2, status=9, edit="2020-03-30 12:00:00"),
        copy(3, status=0, edit="2020-03-30 12:00:00"), copy(9, status=14, edit="2020-03-29 12:00:00"),
    )
    held = copies.circulating_copies(df, lib["location"], lib["scope"], None, D, keep_deleted=True)
    none = rows(CIRC, loan("z", "1999-01-01 00:00:00"))
    daily = transactions.transactions(held, lib["acn"], none, lib["org"], D).collect()
    assert sorted((r.ac_id, r.transaction_type) for r in daily) == [(1, "Lost"), (1, "deleted"), (2, "On Order")]
    strict = transactions.transactions(held, lib["acn"], none, lib["org"], None, strict_reference=True).collect()
    assert sum(r.transaction_type == "deleted" for r in strict) == 4
    corrected = transactions.transactions(held, lib["acn"], none, lib["org"], None).collect()
    assert sum(r.transaction_type == "deleted" for r in corrected) == 1


def test_open_loans_give_no_check_in(rows):
    loans = rows(CIRC, loan("a", "2020-03-30 12:00:00"), loan("b", "2020-03-30 12:00:00", checkin="2020-03-30 13:00:00"))
    corrected = transactions.loan_events(loans, None).collect()
    assert sorted(r.transaction_type for r in corrected) == ["checkin", "circ", "circ"]
    strict = transactions.loan_events(loans, None, strict_reference=True).collect()
    assert sum(r.transaction_type == "checkin" and r.transaction_date is None for r in strict) == 1


def test_circ_stats_month_ends_and_history(rows):
    live = rows(CIRC, loan("a", "2020-02-29 10:00:00"), loan("b", "2020-03-01 00:00:00", checkin="2020-03-05 08:00:00"),
                loan("c", "2020-04-02 00:00:00"), loan("x", "2020-04-02 00:00:00", copy=2))
    aged = rows(CIRC, loan("d", "2019-03-31 09:00:00"), loan("e", "2019-04-01 00:00:00"))
    daily = {r.ac_id: r for r in circ.circ_stats(live, aged, D, D).collect()}
    assert set(daily) == {1}  # copy 2 has no loan before the day
    one = daily[1]
    # a month before 31 March is 29 February; later loans count without an upper bound
    assert (one.all_circs, one.monthly_circs, one.annual_circs) == (4, 2, 4)
    assert (str(one.last_circ), str(one.last_checkin)) == ("2020-03-01", "2020-03-05")
    past = {r.ac_id: r for r in circ.circ_stats(live, aged, "1800-01-01", None).collect()}
    assert (past[1].all_circs, past[1].monthly_circs, past[1].annual_circs) == (5, 5, 5)
    assert past[2].all_circs == 1


def test_latest_loan_library_and_live_date(rows):
    live = rows(CIRC, loan("a", "2020-01-01 00:00:00", lib=3))
    aged = rows(CIRC, loan("b", "2020-02-01 00:00:00", lib=4), loan("c", "2020-02-01 00:00:00", copy=2, lib=4))
    org = rows("id bigint, shortname string", (3, "BR"), (4, "XX"))
    got = {r.ac_id: (r.last_circ_lib, str(r.last_use), r.circ_count) for r in circ.last_circ(live, aged, org).collect()}
    assert got == {1: ("XX", "2020-01-01", 2), 2: ("XX", "None", 1)}


def test_open_holds_asof(rows):
    schema = "id bigint, request_time timestamp_ntz, cancel_time timestamp_ntz, capture_time timestamp_ntz, " \
             "fulfillment_time timestamp_ntz"
    before, after, start = "2020-03-01 00:00:00", "2020-04-01 00:00:00", "2020-01-01 00:00:00"
    df = rows(schema, (1, start, None, None, None), (2, start, before, None, None), (3, start, None, before, None),
              (4, start, None, None, before), (5, start, after, after, after), (6, "2020-03-31 00:00:00", None, None, None),
              (7, start, "2020-03-31 00:00:00", None, None))
    assert sorted(r.id for r in holds.open_holds(df, D).collect()) == [1, 5]


def test_hold_targets_resolve_by_type(rows):
    items = rows("root string, ac_id bigint, acn_id bigint, biblio_id bigint", ("R", 1, 101, 11), ("R", 2, 102, 12), ("R", 3, 102, 12))
    parts = rows("part bigint, target_copy bigint", (50, 2), (50, 1))
    meta = rows("metarecord bigint, source bigint", (70, 99), (70, 98), (71, 5))
    schema = "root string, id bigint, hold_type string, target bigint, current_copy bigint, holds_branch string"
    df = rows(
        schema, ("R", 1, "T", 11, None, "B"), ("R", 2, "T", 500, None, "B"), ("R", 3, "V", 102, None, "B"),
        ("R", 4, "C", 1, None, "B"), ("R", 5, "F", 2, None, "B"), ("R", 6, "R", 3, None, "B"), ("R", 7, "P", 50, None, "B"),
        ("R", 8, "M", 70, 2, "B"), ("R", 9, "M", 70, None, "B"), ("R", 10, "M", 999, 2, "B"), ("R", 11, "M", 70, 400, "B"),
        ("R", 12, "X", 11, None, "B"), ("R", 13, "T", 11, 2, "B"),
    )
    resolver = holds.target_resolver(items, parts, meta)
    got = {r.id: r.biblio_id for r in holds.resolve_targets(df, resolver, meta).collect()}
    assert got == {1: 11, 3: 12, 4: 11, 5: 12, 6: 12, 7: 11, 8: 12, 9: 98, 13: 11}
    counts = holds.hold_counts(holds.fold_holds(df), resolver, meta).collect()
    assert {(r.biblio_id, r.hold_type): r.hold_count for r in counts}[(11, "T")] == 2
    assert sum(r.hold_count for r in counts) == len(got)
    linked = holds.held_metarecords(holds.fold_holds(df), resolver, meta).collect()
    assert sorted((r.metarecord, r.biblio_id) for r in linked) == [(70, 98), (70, 99)]


def test_orders_count_details_per_branch(rows):
    po = rows("id bigint, ordering_agency bigint", (1, 3), (2, 9))
    line = rows("id bigint, purchase_order bigint, eg_bib_id bigint, state string",
                (10, 1, 7, "new"), (11, 1, 7, "on-order"), (12, 1, 7, "received"), (13, 2, 7, "new"))
    detail = rows("id string, lineitem bigint, owning_lib bigint", ("a", 10, 3), ("b", 10, 3), ("c", 11, 3), ("d", 12, 3),
                  ("e", 13, 3), ("f", 11, 4))
    org = rows("id bigint, shortname string", (3, "BR"), (4, "XX"))
    scope = rows("root string, org_id bigint", ("R", 3))
    got = {(r.biblio_id, r.branch): r.order_count for r in orders.order_counts(po, line, detail, org, scope).collect()}
    assert got == {(7, "BR"): 3, (7, "XX"): 1}


def test_uses_since_arrival(rows):
    transit = rows("id bigint, target_copy bigint, dest bigint, dest_recv_time timestamp_ntz",
                   (1, 1, 3, "2020-01-10 00:00:00"), (2, 1, 3, "2020-01-05 00:00:00"), (3, 1, 4, "2020-06-01 00:00:00"),
                   (4, 2, 3, None), (5, 3, 3, "2020-02-01 00:00:00"))
    own = rows("id bigint, circ_lib bigint", (1, 3), (2, 3), (3, 3))
    arrived = circ.arrivals(transit, own)
    loans = rows(CIRC, loan("a", "2020-01-10 00:00:00"), loan("b", "2020-01-10 00:00:01"), loan("c", "2020-03-01 00:00:00"))
    got = {r.ac_id: r.uses_since_arrival for r in circ.loans_after_arrival(loans, arrived).collect()}
    assert got == {1: 2, 3: 0}


ORG = "id bigint, shortname string, name string, ou_type int, parent_ou bigint"


def test_org_scope_at_any_depth(rows):
    tree = rows(ORG, (1, "CONS", "c", 1, None), (2, "SYS", "s", 2, 1), (3, "BR1", "b", 3, 2), (4, "BR2", "b", 3, 2), (5, "OTH", "o", 2, 1))
    got = {(r.root, r.org_id) for r in orgs.org_descendants(tree, ["sys", "oth"]).collect()}
    assert got == {("SYS", 2), ("SYS", 3), ("SYS", 4), ("OTH", 5)}
    assert orgs.org_descendants(tree, ["sys"], match_case=True).count() == 0
    for depth in (6, 7, 8, 14, 20):
        chain = rows(ORG, *[(n, f"U{n}", "u", 1, n - 1 or None) for n in range(1, depth + 1)], (99, "SIDE", "x", 1, 1))
        got = sorted((r.root, r.org_id) for r in orgs.org_descendants(chain, ["u1", "u2"]).collect())
        assert got == sorted([("U1", n) for n in [*range(1, depth + 1), 99]] + [("U2", n) for n in range(2, depth + 1)])
    assert orgs.org_descendants(tree.filter("id < 0"), ["sys"]).count() == 0


def test_org_cycle_fails(rows):
    import pytest

    for length in (1, 3, 6, 7, 15):
        ring = [(n, f"U{n}", "u", 1, n % length + 1) for n in range(1, length + 1)]
        with pytest.raises(Exception, match="cycle"):
            orgs.org_descendants(rows(ORG, *ring, (50, "TAIL", "t", 1, 1)), ["U1"]).collect()


def test_non_mailing_address_comes_first(rows):
    schema = "id bigint, org_unit bigint, address_type string, street1 string, street2 string, city string, state string, post_code string"
    df = rows(schema, (1, 3, "MAILING", "a", "b", "c", "s", "M1"), (2, 3, "PHYSICAL", "p", "q", "c", "s", "P1"),
              (3, 4, "MAILING", "a", None, "c", "s", "M2"), (4, 4, "PHYSICAL", "p", "q", "c", "s", None))
    got = {r.org_unit: (r.post_code, r.address) for r in orgs.first_address(df).collect()}
    assert got == {3: ("P1", "p q;c;s"), 4: ("M2", None)}


def test_day_filters_and_columns_reach_the_parquet_scan(spark, rows, tmp_path):
    lib = library(rows)
    rows(COPY, copy(1), copy(2)).write.parquet(str(tmp_path / "copy"))
    rows(CIRC, loan("a", "2020-03-30 12:00:00")).write.parquet(str(tmp_path / "circ"))
    held = copies.circulating_copies(spark.read.parquet(str(tmp_path / "copy")), lib["location"], lib["scope"], None, D)
    events = transactions.loan_events(spark.read.parquet(str(tmp_path / "circ")), D)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    copy_plan = held.select("id")._jdf.queryExecution().executedPlan().toString()
    loan_plan = events.select("ac_id")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThan(create_date" in copy_plan and "EqualTo(circulate,true)" in copy_plan
    assert "barcode" not in copy_plan
    assert "GreaterThan(xact_start" in loan_plan and "LessThan(checkin_time" in loan_plan
    assert held.count() == 2 and events.count() == 1
