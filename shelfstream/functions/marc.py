"""MARC XML fields as column expressions.

A record is parsed once into an array of data fields; every accessor works on
that parsed column.  Namespace prefixes are ignored, and a malformed record
parses to no fields instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MARC_SCHEMA = "datafield array<struct<_tag: string, subfield: array<struct<_VALUE: string, _code: string>>>>"
_PARSE_OPTIONS = {
    "mode": "PERMISSIVE",
    "ignoreNamespace": "true",
    "attributePrefix": "_",
    "valueTag": "_VALUE",
}


def parse_marc(marc: Column) -> Column:
    """Array of data fields of a record; NULL for NULL or malformed XML."""
    return F.from_xml(marc, MARC_SCHEMA, _PARSE_OPTIONS)["datafield"]


def _subfield_values(field: Column, code: str) -> Column:
    chosen = F.filter(field["subfield"], lambda s: (s["_code"] == code) & s["_VALUE"].isNotNull())
    return F.coalesce(F.transform(chosen, lambda s: s["_VALUE"]), F.array().cast("array<string>"))


def _tagged(fields: Column, *tags: str) -> Column:
    return F.filter(fields, lambda f: f["_tag"].isin(*tags))


def all_values(fields: Column, tags: tuple[str, ...], code: str) -> Column:
    return F.flatten(F.transform(_tagged(fields, *tags), lambda f: _subfield_values(f, code)))


def first_value(fields: Column, tags: tuple[str, ...], code: str) -> Column:
    """First matching subfield in any matching field."""
    return F.get(all_values(fields, tags, code), 0)


def first_field_value(fields: Column, tag: str, code: str) -> Column:
    """First matching subfield of the first field with the tag; later fields do not count."""
    return F.get(_subfield_values(F.get(_tagged(fields, tag), 0), code), 0)


def marc_title(fields: Column) -> Column:
    return F.trim(F.concat_ws(" ", *[first_value(fields, ("245",), code) for code in "abp"]))


def marc_one_element(fields: Column, tags: tuple[str, ...], code: str) -> Column:
    return F.array(first_value(fields, tags, code))


def subject_string(fields: Column, tag: str, normalize) -> Column:
    """Normalised headings joined by ``!!!``, cut to 200 characters and wrapped in ``!!!``."""
    headings = F.transform(all_values(fields, (tag,), "a"), normalize)
    joined = F.when(F.size(headings) > 0, F.array_join(headings, "!!!"))
    return F.concat(F.lit("!!!"), F.substring(joined, 1, 200), F.lit("!!!"))
