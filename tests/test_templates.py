import json

import pytest

from shelfstream.plans.report_registry import REPORTS
from shelfstream.plans.templates import TemplateError, compile_template, read_templates
from shelfstream.workload import ALL_UNITS, REPORT_PARAMETERS, jobs


def column(relation, name, label=None, transform="Bare", **more):
    node = {"relation": relation, "path": f"x-{name}", "column": {"colname": name, "transform": transform}, **more}
    return node if label is None else {**node, "alias": label}


def join(alias, cls, key="id", how="left", **children):
    node = {"alias": alias, "table": f"x.{cls}", "idlclass": cls, "key": key, "join": children}
    return node if how == "inner" else {**node, "type": how}


def added_items():
    """Items added, by name of the owning library; the record's class is known by its table only."""
    record = {"alias": "r", "table": "biblio.record_entry", "key": "id", "type": "left", "join": {"id-rmsr-id-r": join("s", "rmsr")}}
    volume = join("v", "acn", **{"owning_lib-v": join("o", "aou", how="inner"), "record-v": record})
    return {
        "version": 3, "core_class": "acp",
        "select": [column("o", "name", "Owning Library"), column("v", "label", "Call Number"), column("s", "title", "Title"),
                   column("i", "barcode", "Item Barcode")],
        "from": {"alias": "i", "table": "asset.copy", "idlclass": "acp", "join": {"call_number-i": volume}},
        "where": [column("v", "owning_lib", condition={"in": "::P1"}), column("i", "deleted", condition={"=": "f"}),
                  column("i", "create_date", transform="date", condition={"between": "::P0"})],
        "having": [], "order_by": [],
    }


def without_cataloguing():
    return {
        "select": [column("i", "dummy_title", "Precat Title"), column("i", "dummy_author", "Precat Author"), column("i", "barcode", "Barcode")],
        "from": {"alias": "i", "table": "asset.copy", "idlclass": "acp", "join": {"id-circ-target_copy-i": join("c", "circ", "target_copy")}},
        "where": [column("i", "call_number", condition={"=": "-1"}), column("c", "circ_lib", condition={"in": "::P0"})],
    }


def items_of_libraries():
    return {
        "select": [column("o", "name", "Owning Library"), column("i", "id", "Items", "count")],
        "from": {"alias": "i", "table": "asset.copy", "idlclass": "acp",
                 "join": {"call_number-i": join("v", "acn", how="inner", **{"owning_lib-v": join("o", "aou", how="inner")})}},
        "where": [column("i", "deleted", condition={"=": "f"}), column("v", "owning_lib", condition={"in": "::P0"})],
    }


TEMPLATES = {"List Items Added by Date Range": added_items, "List Pre-Cats": without_cataloguing, "Count Items by Library": items_of_libraries}


def test_templates_read_as_rows_give_the_reports_of_the_registry(spark, folder):
    rows = spark.createDataFrame([(name, "Folder", json.dumps(make())) for name, make in TEMPLATES.items()], "name string, folder string, data string")
    found, own = read_templates(rows), jobs(spark, folder)
    assert set(found) == {"rpt_list_items_added_by_date_range", "rpt_list_pre_cats", "rpt_count_items_by_library"}
    for key, report in found.items():
        known = REPORTS[key]
        assert (report.title, report.core, report.columns) == (known.title, known.core, known.columns)
        assert set(report.joins) == set(known.joins) and set(report.filters) == set(known.filters)
        params = [own.t.org_unit.select("id") if p is ALL_UNITS else p for p in REPORT_PARAMETERS[key]]
        expected = sorted(map(repr, own.report(known, params).collect()))
        assert expected and sorted(map(repr, own.report(report, params).collect())) == expected
    assert read_templates(rows.limit(0)) == {}


def test_repeated_classes_are_numbered_in_order():
    data = items_of_libraries()
    data["from"]["join"]["circ_lib-i"] = join("p", "aou", how="inner")
    data["select"].append(column("p", "name", "Other Library"))
    report = compile_template("k", "t", "f", data)
    assert [j.alias for j in report.joins] == ["acn", "aou", "aou2"] and report.columns[-1].source == "aou2.name"
    assert report.joins[-1].left == "acp.circ_lib"


@pytest.mark.parametrize("path, change", [
    ("select[1].column.transform", lambda d: d["select"][1]["column"].update(transform="median")),
    ("select[0].relation", lambda d: d["select"][0].update(relation="zz")),
    ("select[1].alias", lambda d: d["select"][1].update(alias="owning library")),
    ("select", lambda d: d.update(select=[])),
    ("select", lambda d: d.pop("select")),
    ("from.join.call_number-i.type", lambda d: d["from"]["join"]["call_number-i"].update(type="full")),
    ("from.join.call_number-i.key", lambda d: d["from"]["join"]["call_number-i"].pop("key")),
    ("from.join.call_number-i.join.owning_lib-v.idlclass", lambda d: d["from"]["join"]["call_number-i"]["join"]["owning_lib-v"].update(idlclass="nix")),
    ("from.join.call_number-i.join.owning_lib-v.alias", lambda d: d["from"]["join"]["call_number-i"]["join"]["owning_lib-v"].update(alias="v")),
    ("core_class", lambda d: d.update(core_class="circ")),
    ("where[0].condition", lambda d: d["where"][0].update(condition={"like": "x"})),
    ("where[1].condition.in", lambda d: d["where"][1].update(condition={"in": "1"})),
    ("where[0].column.transform", lambda d: d["where"][0]["column"].update(transform="count")),
    ("where", lambda d: d["where"][1].update(condition={"in": "::P1"})),
    ("having[0]", lambda d: d.update(having=[{}])),
    ("order_by[0]", lambda d: d.update(order_by=[{}])),
])
def test_bad_templates_fail_with_the_path_of_the_fault(path, change):
    data = items_of_libraries()
    change(data)
    with pytest.raises(TemplateError, match="^" + path.replace("[", r"\[").replace("]", r"\]") + ": "):
        compile_template("k", "t", "f", data)


def test_all_faults_of_a_table_of_templates_are_named(spark):
    rows = spark.createDataFrame([("A", "f", "{"), ("B", "f", json.dumps(without_cataloguing())), ("b", "f", json.dumps(without_cataloguing())), ("C", "f", None)],
                                 "name string, folder string, data string")
    with pytest.raises(TemplateError, match=r"A: line 1 column 2.*C: line 1 column 1.*b: name: rpt_b is there twice"):
        read_templates(rows)


def test_fixed_values_follow_the_column():
    data = without_cataloguing()
    data["rel_cache"] = {"i": {"fields": {"filter_tab": {"call_number": {"datatype": "text"}}}}}
    assert compile_template("k", "t", "f", data).filters[0].value == "-1"
    data["where"][0]["condition"] = {"between": ["a", "f"]}
    assert compile_template("k", "t", "f", data).filters[0].value == ("a", "f")
