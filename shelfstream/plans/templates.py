"""Stored report templates: a JSON description is compiled to a :class:`Report`.

A template names its core class, a tree of joins, the selected columns and the conditions::

    {"core_class": "acp",
     "from": {"alias": "t0", "table": "asset.copy", "idlclass": "acp",
              "join": {"call_number-t0": {"alias": "t1", "idlclass": "acn", "key": "id", "type": "left", "join": {...}}}},
     "select": [{"alias": "Call Number", "relation": "t1", "column": {"colname": "label", "transform": "Bare"}}],
     "where": [{"relation": "t0", "column": {"colname": "deleted", "transform": "Bare"}, "condition": {"=": "f"}}]}

A join hangs on the column of its parent that its name begins with; without a ``type`` it is an inner one.  A value ``::Pn`` is
run-time parameter n.  Whatever a report cannot express is refused with the path of the place in the template.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame

from shelfstream.functions.dates import DATE_PARTS
from shelfstream.plans.reports import TABLE_OF, Join, Out, Report, Where

# What a stored template calls aggregates and conditions.
AGGREGATES = ("count", "count_distinct", "sum", "max")
CONDITIONS = ("=", "in", "between", ">=")
PARAMETER = re.compile(r"::P(\d+)")


class TemplateError(ValueError):
    """A template that is no report; the message begins with the path of the fault."""


def compile_template(key: str, title: str, folder: str, data: str | dict[str, Any]) -> Report:
    """The report a template describes, with its output columns named after their labels.

    Conditions are ordered by their parameters, so the report takes these in the order of their numbers.
    """
    if isinstance(data, str):
        try:
            data = json.loads(data)
        except json.JSONDecodeError as fault:
            raise TemplateError(f"line {fault.lineno} column {fault.colno}: {fault.msg}") from None
    if not isinstance(data, dict):
        raise TemplateError("$: not an object")
    for part in ("having", "order_by"):
        if data.get(part):
            raise TemplateError(f"{part}[0]: not supported")
    aliases: dict[str, str] = {}
    core = _relation(_part(data, "from", dict, ""), "from", aliases)
    if core != data.get("core_class", core):
        raise TemplateError(f"core_class: {data['core_class']} is not the class of from, {core}")
    joins = tuple(_joins(data["from"], core, "from", aliases))
    columns = tuple(_column(one, f"select[{n}]", aliases) for n, one in enumerate(_part(data, "select", list, "")))
    if not columns:
        raise TemplateError("select: empty")
    names = [c.name for c in columns]
    for n, name in enumerate(names):
        if name in names[:n]:
            raise TemplateError(f"select[{n}].alias: {name} is there twice")
    found = [_condition(one, f"where[{n}]", aliases, data.get("rel_cache") or {}) for n, one in enumerate(data.get("where") or [])]
    numbers = sorted(n for n, _ in found if n is not None)
    if numbers != list(range(len(numbers))):
        raise TemplateError(f"where: parameters {numbers} are not 0 to {len(numbers) - 1}, each once")
    fixed = [w for n, w in found if n is None]
    return Report(key, title, folder, core, joins, columns, tuple(fixed + [w for _, w in sorted((f for f in found if f[0] is not None), key=lambda f: f[0])]))


def read_templates(rows: DataFrame) -> dict[str, Report]:
    """The reports of a table of templates (``name``, ``folder``, ``data``), by key; one bad template fails them all.

    A catalogue has a row for each report, so it is small by its nature; it is compiled on the driver.
    """
    reports: dict[str, Report] = {}
    faults = []
    for row in rows.select("name", "folder", "data").orderBy("name").toLocalIterator():
        key = f"rpt_{_slug(row['name'] or '')}"
        try:
            if key in reports:
                raise TemplateError(f"name: {key} is there twice")
            reports[key] = compile_template(key, row["name"], row["folder"], row["data"] or "")
        except TemplateError as fault:
            faults.append(f"{row['name']}: {fault}")
    if faults:
        raise TemplateError("; ".join(faults))
    return reports


def _slug(label: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", label.lower()).strip("_")


def _part(node: dict[str, Any], name: str, kind: type, path: str) -> Any:
    where = f"{path}.{name}" if path else name
    if name not in node:
        raise TemplateError(f"{where}: missing")
    if not isinstance(node[name], kind):
        raise TemplateError(f"{where}: not {'an object' if kind is dict else 'a list' if kind is list else 'a text'}")
    return node[name]


def _relation(node: dict[str, Any], path: str, aliases: dict[str, str]) -> str:
    """The report's name for a relation: its class, by the table where the class is not given, and a number if it repeats."""
    stored = node.get("idlclass")
    if stored is None:
        table = _part(node, "table", str, path).rpartition(".")[2].removeprefix("materialized_")
        stored = next((cls for cls, own in TABLE_OF.items() if own == table), None)
        if stored is None:
            raise TemplateError(f"{path}.table: no class for {node['table']}")
    if stored not in TABLE_OF:
        raise TemplateError(f"{path}.idlclass: unknown class {stored}")
    taken = sum(name.rstrip("0123456789") == stored for name in aliases.values())
    name = f"{stored}{taken + 1}" if taken else stored
    alias = _part(node, "alias", str, path)
    if alias in aliases:
        raise TemplateError(f"{path}.alias: {alias} is there twice")
    aliases[alias] = name
    return name


def _joins(node: dict[str, Any], parent: str, path: str, aliases: dict[str, str]) -> Iterator[Join]:
    for name, child in (node.get("join") or {}).items():
        here = f"{path}.join.{name}"
        if not isinstance(child, dict):
            raise TemplateError(f"{here}: not an object")
        how = child.get("type", "inner")
        if how not in ("left", "inner"):
            raise TemplateError(f"{here}.type: no {how} joins")
        alias = _relation(child, here, aliases)
        yield Join(alias, f"{parent}.{name.partition('-')[0]}", _part(child, "key", str, here), how)
        yield from _joins(child, alias, here, aliases)


def _source(node: Any, path: str, aliases: dict[str, str]) -> tuple[str, str]:
    """(alias.column, transform) of a selected column or condition."""
    if not isinstance(node, dict):
        raise TemplateError(f"{path}: not an object")
    relation = _part(node, "relation", str, path)
    if relation not in aliases:
        raise TemplateError(f"{path}.relation: {relation} is not joined")
    column = _part(node, "column", dict, path)
    return f"{aliases[relation]}.{_part(column, 'colname', str, f'{path}.column')}", column.get("transform", "Bare")


def _column(node: Any, path: str, aliases: dict[str, str]) -> Out:
    source, transform = _source(node, path, aliases)
    name = _slug(_part(node, "alias", str, path))
    if transform in AGGREGATES:
        return Out(name, source, agg=transform)
    if transform != "Bare" and transform not in DATE_PARTS:
        raise TemplateError(f"{path}.column.transform: unknown {transform}")
    return Out(name, source, part=None if transform == "Bare" else transform)


def _condition(node: Any, path: str, aliases: dict[str, str], cache: dict[str, Any]) -> tuple[int | None, Where]:
    """The parameter's number, or None for a fixed value, and the condition."""
    source, transform = _source(node, path, aliases)
    if transform != "Bare" and transform not in DATE_PARTS:
        raise TemplateError(f"{path}.column.transform: {transform} in a condition")
    condition = _part(node, "condition", dict, path)
    if len(condition) != 1 or next(iter(condition)) not in CONDITIONS:
        raise TemplateError(f"{path}.condition: one of {', '.join(CONDITIONS)} is wanted")
    (op, value), = condition.items()
    part = None if transform == "Bare" else transform
    parameter = PARAMETER.fullmatch(value) if isinstance(value, str) else None
    if parameter:
        return int(parameter[1]), Where(source, op, part)
    if op == "between" and not (isinstance(value, list) and len(value) == 2) or op == "in" and not isinstance(value, list) or value is None:
        raise TemplateError(f"{path}.condition.{op}: {json.dumps(value)} does not fit")
    field = ((cache.get(node["relation"]) or {}).get("fields") or {}).get("filter_tab", {}).get(node["column"]["colname"], {})
    kind = field.get("datatype")
    values = [_literal(v, kind) for v in value] if isinstance(value, list) else _literal(value, kind)
    return None, Where(source, op, part, tuple(values) if isinstance(values, list) else values)


def _literal(value: Any, kind: str | None) -> Any:
    """A stored value by its kind: t and f are truth values, digits are numbers, unless the column holds text."""
    if not isinstance(value, str) or kind == "text":
        return value
    if value in ("t", "f") and kind in (None, "bool"):
        return value == "t"
    return int(value) if re.fullmatch(r"-?\d+", value) else value
