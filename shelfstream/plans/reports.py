"""Declarative reports: a join tree, filters, grouping columns and aggregates.

When a report has an aggregate, its other columns are the grouping keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfstream.functions.dates import date_part


@dataclass(frozen=True)
class Join:
    """Join table ``alias`` where ``left`` (``alias.column``) equals its ``key``."""

    alias: str
    left: str
    key: str
    how: str = "left"


@dataclass(frozen=True)
class Out:
    """Output column: a source column, optionally through a date part or an aggregate."""

    name: str
    source: str
    part: str | None = None
    agg: str | None = None


@dataclass(frozen=True)
class Where:
    """Condition on a source column; ``value`` is set for conditions fixed by the report.

    Conditions without a fixed value take the run-time parameters in order.
    """

    source: str
    op: str
    part: str | None = None
    value: Any = None


@dataclass(frozen=True)
class Report:
    key: str
    title: str
    folder: str
    core: str
    joins: tuple[Join, ...]
    columns: tuple[Out, ...]
    filters: tuple[Where, ...]
    # Leaf tables whose rows are counted (or reduced to a maximum) per join key before they are joined.
    fold_leaves: tuple[str, ...] = ()
    # (leaf, parent): the folded leaf joins its parent first, and the parent keeps one row per joined value.  For
    # reports whose aggregates are all maxima, where the number of rows that meet a group does not matter.
    fold_chains: tuple[tuple[str, str], ...] = ()
    # Left-joined tables with many rows for one key: an inner join, whose sides can both be split at run time, and the
    # rows without a match.
    many: tuple[str, ...] = ()
    # Leaf tables reduced to their distinct rows before they are joined.
    distinct_leaves: tuple[str, ...] = ()
    # Every other join is a look-up by primary key, so no row meets an output group
    # twice and counting distinct primary keys is plain counting.
    unique_counts: bool = False

    @property
    def aggregates(self) -> tuple[Out, ...]:
        return tuple(c for c in self.columns if c.agg)

    @property
    def parameter_count(self) -> int:
        return sum(1 for f in self.filters if f.value is None)


# Which contract table each class of the join tree stands for.
TABLE_OF = {
    "acp": "copy", "acn": "call_number", "bre": "record_entry", "rmsr": "simple_record", "aou": "org_unit",
    "acpl": "copy_location", "circ": "circulation", "au": "usr", "ac": "card", "aua": "usr_address",
    "ccm": "circ_modifier", "ccs": "copy_status", "pgt": "grp_tree", "aws": "workstation", "ahr": "hold_request",
    "mrd": "rec_descriptor", "citm": "item_type_map", "ascecm": "asset_stat_cat_map", "asce": "asset_stat_cat_entry",
    "asc": "asset_stat_cat", "aoc": "open_circulation", "mobts": "open_billable_xact_summary",
    "actscecm": "actor_stat_cat_map", "actsc": "actor_stat_cat", "actsce": "actor_stat_cat_entry",
    "aihu": "in_house_use", "atc": "transit_copy", "ahtc": "hold_transit_copy", "ancc": "non_cataloged_circulation",
    "cnct": "non_cataloged_type", "mbt": "billable_xact", "rcirct": "circ_type", "rhcrpb": "hold_copy_ratio",
}


def table_of(alias: str) -> str:
    return TABLE_OF[alias.rstrip("0123456789")]


def _split(source: str) -> tuple[str, str]:
    alias, column = source.split(".")
    return alias, column


def _flat(source: str) -> str:
    return source.replace(".", "__")


def _apply(df: DataFrame, where: Where, value: Any) -> DataFrame:
    column: Column = F.col(_split(where.source)[1])
    if where.part:
        column = date_part(where.part, column)
    if where.op == "=":
        return df.filter(column == F.lit(value))
    if where.op == ">=":
        return df.filter(column >= F.lit(value))
    if where.op == "between":
        return df.filter(column.between(F.lit(value[0]), F.lit(value[1])))
    if where.op == "in":
        if isinstance(value, DataFrame):
            wanted = value.select(F.col(value.columns[0]).alias("_wanted"))
            return df.join(wanted, column == F.col("_wanted"), "left_semi")
        return df.filter(column.isin(list(value)))
    raise ValueError(f"unknown operator {where.op}")


def _core_folds(report: Report) -> bool:
    """Core rows may be counted before the joins unless a join needs their unique id."""
    foldable = ("count", "sum", "count_distinct") if report.unique_counts else ("count", "sum")
    if not report.aggregates or any(a.agg not in foldable for a in report.aggregates):
        return False
    if any(_split(a.source)[0] != report.core and _split(a.source)[0] not in report.fold_leaves for a in report.aggregates):
        return False
    return all(j.left != f"{report.core}.id" for j in report.joins)


def run_report(
    report: Report, table: Callable[[str], DataFrame], params: Sequence[Any], ordered: bool = False
) -> DataFrame:
    """Build the report's DataFrame.

    Every condition is applied to its own table before the joins, and makes
    that table's join an inner one (all operators reject NULL).  Counts and
    sums over the core table are taken per join key and grouping value before
    the joins, so a library or patron with a large share of the rows reaches
    the joins as a handful of rows.
    """
    if len(params) != report.parameter_count:
        raise ValueError(f"{report.key} takes {report.parameter_count} parameters")
    supplied = iter(params)
    conditions: dict[str, list[tuple[Where, Any]]] = {}
    for where in report.filters:
        value = where.value if where.value is not None else next(supplied)
        conditions.setdefault(_split(where.source)[0], []).append((where, value))

    needed: dict[str, set[str]] = {report.core: set()}
    for join in report.joins:
        needed.setdefault(join.alias, set()).add(join.key)
        left_alias, left_column = _split(join.left)
        needed[left_alias].add(left_column)
    for out in report.columns:
        if not out.agg:
            alias, column = _split(out.source)
            needed[alias].add(column)
    aggregated: dict[str, list[Out]] = {}
    for out in report.aggregates:
        aggregated.setdefault(_split(out.source)[0], []).append(out)

    grouped_parts = {o.source: o.part for o in report.columns if o.part and not o.agg}
    joined_columns = {j.left for j in report.joins} | {f"{j.alias}.{j.key}" for j in report.joins}
    fold_core = _core_folds(report)

    def prepare(alias: str, fold: bool) -> DataFrame:
        df = table(table_of(alias))
        for where, value in conditions.get(alias, ()):
            df = _apply(df, where, value)
        types = dict(df.dtypes)
        columns = []
        for name in sorted(needed[alias]):
            source = f"{alias}.{name}"
            value = F.array_join(name, ",") if types[name].startswith("array") else F.col(name)
            if source in grouped_parts and source not in joined_columns:
                value = date_part(grouped_parts[source], value)
            columns.append(value.alias(_flat(source)))
        if fold:
            partial = {"sum": F.sum, "max": F.max}
            values = [
                partial[o.agg](_split(o.source)[1]).alias(f"_{o.agg}_{o.name}")
                for o in aggregated.get(alias, ()) if o.agg in partial
            ]
            return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(f"_n_{alias}"), *values)
        if alias in report.distinct_leaves:
            return df.select(*columns).distinct()
        extra = [
            F.col(_split(o.source)[1]).alias(f"_agg_{o.name}") for o in aggregated.get(alias, ())
        ]
        return df.select(*columns, *extra)

    def prepare_chain(parent: str, leaf: Join) -> DataFrame:
        on = F.col(_flat(leaf.left)) == F.col(_flat(f"{leaf.alias}.{leaf.key}"))
        rows = prepare(parent, False).join(prepare(leaf.alias, True), on, "left")
        keys = [_flat(f"{parent}.{name}") for name in sorted(needed[parent] - {_split(leaf.left)[1]})]
        return rows.groupBy(*keys).agg(*[F.max(f"_max_{o.name}").alias(f"_max_{o.name}") for o in aggregated[leaf.alias]])

    leaves = {parent: next(j for j in report.joins if j.alias == leaf) for leaf, parent in report.fold_chains}
    inside = {join.alias for join in leaves.values()}
    folded = ({report.core} if fold_core else set()) | inside
    result = prepare(report.core, fold_core)
    for join in report.joins:
        if join.alias in inside:
            continue
        leaf = join.alias in report.fold_leaves
        if leaf:
            folded.add(join.alias)
        right = prepare_chain(join.alias, leaves[join.alias]) if join.alias in leaves else prepare(join.alias, leaf)
        how = "inner" if join.how == "inner" or join.alias in conditions else "left"
        key = _flat(f"{join.alias}.{join.key}")
        on = F.col(_flat(join.left)) == F.col(key)
        if how == "left" and join.alias in report.many:
            unmatched = result.join(right.select(key).distinct(), on, "left_anti")
            result = result.join(right, on).unionByName(unmatched, allowMissingColumns=True)
        else:
            result = result.join(right, on, how)

    def output(out: Out) -> Column:
        value = F.col(_flat(out.source))
        if out.part and out.source in joined_columns:
            value = date_part(out.part, value)
        return value.alias(out.name)

    keys = [output(c) for c in report.columns if not c.agg]
    if report.aggregates:
        aggregates = report.aggregates
        if report.unique_counts:
            aggregates = tuple(replace(a, agg="count") if a.agg == "count_distinct" else a for a in aggregates)
        result = result.groupBy(*keys).agg(*[_aggregate(a, folded) for a in aggregates])
        result = result.select(*[c.name for c in report.columns])
    else:
        result = result.select(*keys)
    return result.orderBy(*[c.name for c in report.columns]) if ordered else result


def _aggregate(out: Out, folded: set[str]) -> Column:
    alias, _ = _split(out.source)
    if out.agg == "max" and alias in folded:
        return F.max(f"_max_{out.name}").alias(out.name)
    if not folded or out.agg in ("max", "count_distinct"):
        value = F.col(f"_agg_{out.name}")
        functions = {"count": F.count, "count_distinct": F.count_distinct, "sum": F.sum, "max": F.max}
        return functions[out.agg](value).alias(out.name)
    others = F.lit(1).cast("bigint")
    for name in folded:
        if name != alias:
            others = others * F.coalesce(F.col(f"_n_{name}"), F.lit(1))
    if out.agg == "sum":
        return F.sum(F.col(f"_sum_{out.name}") * others).alias(out.name)
    if alias in folded:
        own = F.coalesce(F.col(f"_n_{alias}"), F.lit(0))
    else:
        own = F.when(F.col(f"_agg_{out.name}").isNotNull(), 1).otherwise(0).cast("bigint")
    return F.coalesce(F.sum(own * others), F.lit(0)).alias(out.name)


def report_catalog(spark: SparkSession, reports: Sequence[Report]) -> DataFrame:
    """One row per report: key, title, folder, core table and shape."""
    rows = [
        (r.key, r.title, r.folder, table_of(r.core), len(r.joins), len(r.columns), len(r.aggregates), r.parameter_count)
        for r in reports
    ]
    return spark.createDataFrame(
        rows, "key string, title string, folder string, core string, joins int, columns int, aggregates int, parameters int"
    )
