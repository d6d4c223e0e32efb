"""Binds a report specification to a dataset: validation, literals, and the physical list of aggregates. Driver only."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import transforms
from quarrymill.operators import dictionary as enums
from quarrymill.operators.intervals import Interval, interval, report_range, to_utc
from quarrymill.operators.predicates import NUMBER, UnsupportedOperator, canonical, predicate
from quarrymill.plans.spec import ColumnSpec, DatasetSpec, ReportSpec

BUCKET = "request_time"
PHYSICAL = ("count", "sum", "min", "max")
DISTINCT = ("distinct", "distinct_exclude_null")


class InvalidReport(ValueError):
    """The specification contradicts itself or the dataset."""


@dataclass(frozen=True)
class Requested:
    column: str
    aggregate: str
    alias: str


@dataclass
class BoundReport:
    spec: ReportSpec
    dataset: DatasetSpec
    rtype: Interval | None
    low: datetime | None
    high: datetime | None
    where: list[Column] = field(default_factory=list)
    raw_where: list[Column] = field(default_factory=list)
    semi: list[tuple[str, DataFrame]] = field(default_factory=list)  # a column, and a table whose ``_id`` it must be in
    empty: bool = False
    keys: list[ColumnSpec] = field(default_factory=list)
    requested: list[Requested] = field(default_factory=list)
    physical: list[tuple[str, str]] = field(default_factory=list)
    distinct: list[tuple[str, str]] = field(default_factory=list)
    distinct_alias: str | None = None
    having: list[tuple[str, str, object]] = field(default_factory=list)
    sort: list[tuple[str, bool]] = field(default_factory=list)

    @property
    def utc_range(self) -> tuple[datetime | None, datetime | None]:
        """The range in UTC; ``low`` and ``high`` are by the wall clock of the dataset's zone."""
        return tuple(t and to_utc(t, self.dataset.timezone) for t in (self.low, self.high))


def _value(v, text_only: bool = False):
    """A literal that is given as JSON; text that isn't JSON stands for itself. text_only: lists and objects are text, too."""
    if isinstance(v, str) and v[:1] in ('"' if text_only else '[{"'):
        try:
            return json.loads(v)
        except ValueError:
            return v
    return v


#: Text operators that compare with one text, not a list of them.
_ONE_TEXT = {f"{no}{op}" for no in ("", "not ") for op in ("==", "!=", "contain", "startswith", "endswith")}


def _literal(spec: ColumnSpec, name: str, v):
    return _value(v, spec.dtype.is_string and not spec.dtype.is_list and name in _ONE_TEXT)


def _coerce(spec: ColumnSpec, v):
    if isinstance(v, list | tuple):
        return [_coerce(spec, x) for x in v]
    if spec.dtype.is_number:
        return int(v) if 100 <= spec.dtype.scalar_id < 200 else float(v)
    return str(v)


def bind_condition(spec: ColumnSpec, op: str, value, words: DataFrame | None, options: dict) -> Column | tuple[str, DataFrame] | None:
    """One condition: a test, or a column and the table of ids that it must be in; None if its labels are unknown, so that nothing can match."""
    name = canonical(op)
    value = _literal(spec, name, value)
    c = F.col(f"`{spec.name}`")
    if spec.enum and words is not None:
        if name == "pattern":
            return spec.name, enums.search(words, spec.enum, value).select(F.col("id").alias("_id"))
        several = isinstance(value, list | tuple)
        labels = [str(x) for x in (value if several else [value])]
        known = enums.lookup(words, spec.enum, labels)
        ids = [known[x] for x in labels if x in known]
        # An unknown label has no rows to compare with, whatever the operator.
        if not ids:
            return None
        value = ids if several else ids[0]
        return predicate(c, spec.dtype, name, value, options.get("list_in_mode", "union"))
    if options.get("transform_literals") and spec.transformer:
        one = lambda x: transforms.apply(spec.transformer.name, F.lit(x), **spec.transformer.parameters)
        return predicate(c, spec.dtype, name, [one(x) for x in value] if isinstance(value, list | tuple) else one(value))
    return predicate(c, spec.dtype, name, _coerce(spec, value), options.get("list_in_mode", "union"))


def bind(spec: ReportSpec, dataset: DatasetSpec, words: DataFrame | None = None) -> BoundReport:
    rtype = interval(spec.rtype) if spec.rtype is not None else None
    data = interval(dataset.data_interval)
    if rtype and rtype.id < data.id:
        raise InvalidReport("the report's interval is finer than the data's")
    low, high = spec.start, spec.end
    if low and high:
        low, high = report_range(rtype or data, low, high, spec.periodic)
        if low > high:
            raise InvalidReport("the range ends before it starts")
    out = BoundReport(spec, dataset, rtype, low, high)
    strict = spec.options.get("strict", True)
    for name, op, value in spec.conditions:
        column = dataset.column(name)
        if strict and not column.filterable:
            raise InvalidReport(f"column {name} isn't filterable")
        bound = bind_condition(column, op, value, words, spec.options)
        if bound is None:
            out.empty = True
        elif isinstance(bound, tuple):
            out.semi.append(bound)
        else:
            out.where.append(bound)
    if spec.is_details:
        # Conditions on the raw text, before any transformer; of no effect on statistics.
        for name, op, value in spec.raw_conditions:
            column = dataset.column(name)
            out.raw_where.append(predicate(F.col(f"`{name}`"), column.dtype, op, _coerce(column, _literal(column, canonical(op), value)), spec.options.get("list_in_mode", "union")))
        return out
    return _aggregates(out)


def _aggregates(out: BoundReport) -> BoundReport:
    spec, dataset = out.spec, out.dataset
    for name in dict.fromkeys(spec.group_by):
        column = dataset.column(name)
        if not (column.groupable or column.distinctable):
            raise InvalidReport(f"column {name} isn't groupable")
        out.keys.append(column)
    physical: list[tuple[str, str]] = []
    for name, agg, alias in spec.resultset:
        if not agg:
            raise InvalidReport(f"no aggregate for {name}")
        agg = agg.lower()
        if agg in DISTINCT:
            column = dataset.column(name)
            if not (column.distinctable or column.groupable):
                raise InvalidReport(f"column {name} isn't distinctable")
            out.distinct.append((name, agg))
            out.distinct_alias = out.distinct_alias or alias
            continue
        if agg == "count":
            physical.append(("*", "count"))
        elif agg in (*PHYSICAL, "avg"):
            column = dataset.column(name)
            if not column.statistical:
                raise InvalidReport(f"column {name} isn't statistical")
            if not column.dtype.is_number or column.dtype.is_list:
                raise UnsupportedOperator(f"{agg} of type {column.dtype.id}")
            if name in spec.group_by:
                raise InvalidReport(f"column {name} is a group key")
            physical += [(name, "sum"), ("*", "count")] if agg == "avg" else [(name, agg)]
        else:
            raise InvalidReport(f"unknown aggregate {agg!r}")
        out.requested.append(Requested(name, agg, alias or f"{name}-{agg}"))
    if out.distinct:
        out.distinct_alias = out.distinct_alias or f"count(distinct {', '.join(n for n, _ in out.distinct)})"
    # Once each, in order of column and aggregate.
    out.physical = sorted(set(physical), key=lambda p: (p[0] != "*", p))
    known = {r.alias for r in out.requested} | ({"distinct", out.distinct_alias} if out.distinct else set())
    for alias, op, value in spec.having:
        if alias in known and canonical(op) in NUMBER:
            out.having.append((out.distinct_alias if alias == "distinct" else alias, canonical(op), _value(value)))
    if out.keys or out.rtype:
        keys = {c.name for c in out.keys}
        for name, order in spec.sort_by:
            name = out.distinct_alias if name == "distinct" and out.distinct else name
            if name in keys | known:
                out.sort.append((name, order == "asc"))
    return out
