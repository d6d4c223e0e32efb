"""From raw rows of text to typed columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import transforms
from quarrymill.functions.types import parse
from quarrymill.plans.spec import ColumnSpec, DatasetSpec


def _source(spec: ColumnSpec) -> str:
    return spec.source or spec.name


def transformed(spec: ColumnSpec, value: Column, record: dict[str, Column]) -> Column:
    return transforms.apply(spec.transformer.name, value, record, **spec.transformer.parameters) if spec.transformer else value


def normalized(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rewrites source columns by SQL, all at once, before anything else."""
    new = {_source(c): F.expr(c.normalize) for c in spec.columns if c.normalize}
    return raw.withColumns(new) if new else raw


def with_computed(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Adds new computed columns, then replaces overridden ones, as text in the data."""
    record = lambda df: {c: df[f"`{c}`"] for c in df.columns}
    for kind in ("new", "override"):
        cols = {c.name: transformed(c, raw[f"`{_source(c)}`"], record(raw)).cast("string") for c in spec.columns if c.computed == kind}
        raw = raw.withColumns(cols) if cols else raw
    return raw.select(*spec.header, *(c for c in raw.columns if c not in spec.header)) if spec.header else raw


def kept(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Drops rows that an exclusion hits; of those with inclusions at least one must hit, for each source column."""
    tests = []
    any_of = lambda conds: reduce(lambda a, b: a | b, (F.coalesce(F.expr(c), F.lit(False)) for c in conds))
    for source in dict.fromkeys(map(_source, spec.columns)):
        own = [c for c in spec.columns if _source(c) == source]
        excl, incl = [x for c in own for x in c.exclude], [x for c in own for x in c.include]
        if excl:
            tests.append(~any_of(excl))
        if incl:
            tests.append(any_of(incl))
    return raw.where(reduce(lambda a, b: a & b, tests)) if tests else raw


def typed(raw: DataFrame, spec: DatasetSpec, *keep: str) -> DataFrame:
    """The columns that reports use, typed, and ``keep`` as they are."""
    record = {c: F.col(f"`{c}`") for c in raw.columns}
    cols = [parse(transformed(c, F.col(f"`{_source(c)}`"), record) if not c.computed else F.col(f"`{c.name}`"), c.dtype).alias(c.name) for c in spec.columns if c.used]
    return raw.select(*keep, *cols)


def prepare(raw: DataFrame, spec: DatasetSpec, *keep: str) -> DataFrame:
    """Normalise, compute, drop noise, type."""
    return typed(kept(with_computed(normalized(raw, spec), spec), spec), spec, *keep)


def with_issues(raw: DataFrame, spec: DatasetSpec, *keep: str) -> tuple[DataFrame, DataFrame]:
    """(typed rows, issues): values that were there and couldn't be read, or of which a transformer made nothing, are listed, not raised."""
    rows = kept(with_computed(normalized(raw, spec), spec), spec)
    record = {c: F.col(f"`{c}`") for c in rows.columns}
    found = []
    for c in spec.columns:
        value = record[_source(c)]
        text = value.cast("string")
        given = value.isNotNull() & (F.trim(text) != "")
        if c.transformer and not c.computed:
            bad, message = given & transformed(c, value, record).isNull(), f"{c.transformer.name} gives nothing"
        elif c.dtype.is_number and not c.dtype.is_list:
            bad, message = given & text.try_cast("double").isNull(), "can't be read"
        else:
            continue  # text and truth values take any text
        if c.used:
            found.append(F.when(bad, F.struct(F.lit(c.name).alias("column"), text.alias("value"), F.lit(message).alias("message"))))
    if not found:
        return typed(rows, spec, *keep), raw.sparkSession.createDataFrame([], "column string, value string, message string")
    # One pass over the rows, whatever the number of columns.
    issues = rows.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("i")).select("i.*")
    return typed(rows, spec, *keep), issues
