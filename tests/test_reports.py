from datetime import date

import pytest

from shelfstream.plans import reports as builder
from shelfstream.plans.report_registry import REPORTS
from shelfstream.plans.reports import TABLE_OF, Join, Out, Report, Where, report_catalog, run_report, table_of
from shelfstream.workload import REPORT_PARAMETERS, jobs


def test_catalogue_is_complete_and_consistent(spark):
    assert len(REPORTS) == 57 and set(REPORT_PARAMETERS) == set(REPORTS)
    listed = report_catalog(spark, list(REPORTS.values()))
    assert listed.count() == 57 and listed.select("key").distinct().count() == 57
    for report in REPORTS.values():
        aliases = [report.core, *[j.alias for j in report.joins]]
        assert len(set(aliases)) == len(aliases), report.key
        known = set()
        for alias in aliases:
            assert table_of(alias) in TABLE_OF.values()
        known.add(report.core)
        for join in report.joins:
            assert join.left.split(".")[0] in known, report.key
            known.add(join.alias)
        for part in (*report.columns, *report.filters):
            assert part.source.split(".")[0] in known, report.key
        assert len(REPORT_PARAMETERS[report.key]) == report.parameter_count


def tiny(rows):
    tables = {
        "circulation": rows("id string, circ_lib bigint, usr bigint, xact_start timestamp_ntz",
                            ("a", 1, 5, "2020-01-01 10:00:00"), ("b", 1, 5, "2020-01-20 10:00:00"),
                            ("c", 2, 6, "2020-02-01 10:00:00"), ("d", 9, 6, "2020-02-01 10:00:00"), ("e", 1, None, "2021-01-01 10:00:00")),
        "org_unit": rows("id bigint, name string", (1, "One"), (2, "Two")),
        "usr_address": rows("usr bigint, city string", (5, "X"), (5, "Y")),
    }
    return tables.__getitem__


def sample(how="inner"):
    return Report(
        "k", "t", "f", "circ", (Join("aou", "circ.circ_lib", "id", how), Join("aua", "circ.usr", "usr")),
        (Out("month", "circ.xact_start", part="month_trunc"), Out("name", "aou.name"), Out("city", "aua.city"),
         Out("n", "circ.id", agg="count")),
        (Where("circ.xact_start", "between", "date"),),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_counting_before_the_joins_changes_nothing(rows, how, monkeypatch):
    params = [(date(2020, 1, 1), date(2020, 12, 31))]
    folded = sorted(map(str, run_report(sample(how), tiny(rows), params).collect()))
    monkeypatch.setattr(builder, "_core_folds", lambda report: False)
    plain = sorted(map(str, run_report(sample(how), tiny(rows), params).collect()))
    assert folded == plain and len(folded) == (3 if how == "inner" else 4)


def test_distinct_counts_by_primary_key(rows, monkeypatch):
    tables = {
        "circulation": rows("id string, usr bigint", ("a", 5), ("b", 5), ("c", 6), ("d", None)),
        "usr_address": rows("usr bigint, city string", (5, "X"), (5, "X"), (5, "Y"), (7, "Z")),
    }.__getitem__
    shape = ("k", "t", "f", "circ", (Join("aua", "circ.usr", "usr"),),
             (Out("city", "aua.city"), Out("n", "circ.id", agg="count_distinct")), ())
    folded = run_report(Report(*shape, distinct_leaves=("aua",), unique_counts=True), tables, [])
    plain = run_report(Report(*shape), tables, [])
    assert sorted(map(str, folded.collect())) == sorted(map(str, plain.collect()))
    assert {(r.city, r.n) for r in folded.collect()} == {("X", 2), ("Y", 2), (None, 2)}


def test_ordered_output_and_parameter_check(rows):
    out = run_report(sample(), tiny(rows), [(date(2020, 1, 1), date(2020, 12, 31))], ordered=True).collect()
    assert [r.month for r in out] == sorted(r.month for r in out)
    with pytest.raises(ValueError, match="takes 1 parameters"):
        run_report(sample(), tiny(rows), [])


def test_filters_reach_the_scan(spark, folder):
    j = jobs(spark, folder)
    report = REPORTS["rpt_count_circulations_by_hour_of_the_day"]
    df = j.report(report, [(date(1998, 1, 1), date(1998, 2, 1)), [1001, 1002]])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "partial_count" in plan
