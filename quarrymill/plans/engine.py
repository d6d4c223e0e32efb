"""Compiles a bound report to one lazy DataFrame."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions import transforms
from quarrymill.operators import dictionary as enums
from quarrymill.operators.intervals import UTC, interval, wall_clock
from quarrymill.operators.predicates import NUMBER
from quarrymill.plans.planner import BUCKET, BoundReport, bind
from quarrymill.plans.spec import DatasetSpec, ReportSpec

_KEEP = "__id__"


def physical_name(column: str, agg: str) -> str:
    return "count" if agg == "count" else f"{column}_{agg}"


def _all(df: DataFrame, tests: list[Column]) -> DataFrame:
    for t in tests:
        df = df.where(t)
    return df


def _instant(at: datetime, kind: T.DataType, zone: str) -> Column:
    """A time in UTC as a value of the time column's type."""
    if zone != UTC and kind.typeName() == "timestamp":
        return F.lit(at.replace(tzinfo=timezone.utc))
    return F.lit(at).cast(kind)


def selected(bound: BoundReport, df: DataFrame) -> DataFrame:
    """Rows in the range that meet the conditions; the range prunes partitions by the time column."""
    time, zone = F.col(bound.dataset.time_column), bound.dataset.timezone
    low, high = bound.utc_range
    if low is not None:
        df = df.where(time >= _instant(low, df.schema[bound.dataset.time_column].dataType, zone))
    if high is not None:
        df = df.where(time < _instant(high, df.schema[bound.dataset.time_column].dataType, zone))
    df = df.where(F.lit(False)) if bound.empty else _all(df, bound.where)
    for name, ids in bound.semi:
        df = df.join(ids, F.col(f"`{name}`") == F.col("_id"), "left_semi")
    return df


def bucket(bound: BoundReport, time: Column) -> Column:
    """time: by the wall clock of the dataset's zone."""
    if bound.spec.options.get("bucket_mode", "floor") == "label":
        return bound.rtype.label(time)
    return bound.rtype.column(time, bound.low)


def counted(bound: BoundReport) -> Column:
    """Whether a tuple counts: one of its plain columns is there, or one of the others isn't empty, zero or false."""
    if any(kind == "distinct" for _, kind in bound.distinct):
        return F.lit(True)
    filled = F.lit(False)
    for name, _ in bound.distinct:
        d, c = bound.dataset.column(name).dtype, F.col(f"`{name}`")
        filled = filled | (F.size(c) > 0 if d.is_list else c if d.is_bool else c != "" if d.is_string else c != 0)
    return filled


def distinct(bound: BoundReport, rows: Column | None = None) -> Column:
    """Distinct tuples of the rows that count."""
    which = counted(bound) if rows is None else counted(bound) & rows
    return F.count_distinct(F.when(which, F.struct(*(F.col(f"`{n}`") for n, _ in bound.distinct))))


def physical_columns(bound: BoundReport) -> list[Column]:
    make = {"count": lambda c: F.count(F.lit(1)), "sum": F.sum, "min": F.min, "max": F.max}
    out = [make[agg](F.col(f"`{name}`") if name != "*" else None).alias(physical_name(name, agg)) for name, agg in bound.physical]
    return [distinct(bound).alias("distinct"), *out] if bound.distinct else out


def _filled(bound: BoundReport, df: DataFrame) -> DataFrame:
    """Without rows counts and sums are 0; least and greatest stay null unless asked to be 0."""
    zero = bound.spec.options.get("empty_minmax", "null") == "zero"
    names = [physical_name(n, a) for n, a in bound.physical if a in ("count", "sum") or zero] + (["distinct"] if bound.distinct else [])
    return df.withColumns({n: F.coalesce(F.col(f"`{n}`"), F.lit(0).cast(df.schema[n].dataType)) for n in names})


def _spine(bound: BoundReport, spark: SparkSession) -> DataFrame:
    """Every bucket of the range; a row for each, made on the executors. Minutes and hours are those that pass, which a zone's clock may skip or show twice."""
    data, zone = interval(bound.dataset.data_interval), bound.dataset.timezone
    step = {"minutes": "minute", "hours": "hour", "days": "day", "weeks": "day", "months": "month"}[data.kind]
    n = data.n * (7 if data.kind == "weeks" else 1)
    lit = lambda t: f"timestamp_ntz'{t:%Y-%m-%d %H:%M:%S}'"
    passing = data.kind in ("minutes", "hours")
    low, high = bound.utc_range if passing else (bound.low, bound.high)
    times = spark.range(1).select(F.explode(F.expr(f"sequence({lit(low)}, {lit(high)}, interval {n} {step})")).alias("t")).where(F.col("t") < F.expr(lit(high)))
    wall = wall_clock(F.col("t"), "timestamp_ntz", zone) if passing else F.col("t")
    return times.select(bucket(bound, wall).alias(BUCKET)).distinct()


def aggregate(bound: BoundReport, df: DataFrame) -> DataFrame:
    """The raw (physical) result: keys, then physical aggregates."""
    return grouped(bound, selected(bound, df), physical_columns(bound))


def grouped(bound: BoundReport, rows: DataFrame, columns: list[Column]) -> DataFrame:
    """Aggregates by bucket and keys; without keys a row for each bucket of the range."""
    keys = [F.col(f"`{c.name}`") for c in bound.keys]
    if bound.rtype:
        time = bound.dataset.time_column
        wall = wall_clock(F.col(time), rows.schema[time].dataType.typeName(), bound.dataset.timezone)
        keys = [bucket(bound, wall).alias(BUCKET), *keys]
    out = rows.groupBy(*keys).agg(*columns) if keys else rows.agg(*columns)
    if bound.rtype and not bound.keys and bound.low and bound.high:
        spine = _spine(bound, rows.sparkSession)
        out = spine.join(out.withColumn(BUCKET, F.col(BUCKET).cast(spine.schema[BUCKET].dataType)), BUCKET, "left")
    return out if bound.keys else _filled(bound, out)


def final(bound: BoundReport, raw: DataFrame, words: DataFrame | None) -> DataFrame:
    """Requested columns in their order, decoded, filtered and sorted."""
    out = raw
    order: dict[str, str] = {}
    for c in bound.keys:
        if c.enum and words is not None:
            hidden = f"{_KEEP}{c.name}"
            out = enums.decode(out, c.name, words, c.enum, keep=hidden if c.group_enum else None)
            order[c.name] = hidden if c.group_enum else c.name
    values = []
    if bound.distinct:
        values.append(F.col("distinct").alias(bound.distinct_alias))
    for r in bound.requested:
        n = F.col("`count`") if any(a == "count" for _, a in bound.physical) else None
        if r.aggregate == "avg":
            v = F.when(n > 0, F.col(f"`{r.column}_sum`") / n).otherwise(F.lit(0.0))
        else:
            v = F.col(f"`{physical_name(r.column, r.aggregate)}`")
        values.append(v.alias(r.alias))
    keys = ([BUCKET] if bound.rtype else []) + [c.name for c in bound.keys]
    hidden = [h for h in order.values() if h.startswith(_KEEP)]
    out = out.select(*(F.col(f"`{k}`") for k in keys), *hidden, *values)
    for alias, op, value in bound.having:
        out = out.where(NUMBER[op](F.col(f"`{alias}`"), value))
    sort = [F.col(BUCKET).asc()] if bound.rtype else []
    sort += [(c.asc() if up else c.desc()) for c, up in ((F.col(f"`{order.get(n, n)}`"), up) for n, up in bound.sort)]
    if sort and keys:
        out = out.orderBy(*sort)
    if limit := bound.spec.options.get("limit"):
        out = out.limit(limit)
    render = {c.name: transforms.apply(c.to_string, F.col(f"`{c.name}`")) for c in bound.keys if c.to_string}
    out = out.withColumns(render) if render else out
    return out.drop(*hidden)


def run_statistics(spark: SparkSession, spec: ReportSpec, dataset: DatasetSpec, df: DataFrame, words: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(final, raw) of a statistics report over a prepared table."""
    bound = bind(spec, dataset, words)
    raw = aggregate(bound, df)
    return final(bound, raw, words), raw


def run_details(spark: SparkSession, spec: ReportSpec, dataset: DatasetSpec, df: DataFrame, words: DataFrame | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """The matching rows themselves, in the order of their interval and place."""
    bound = bind(spec, dataset, words)
    out = _all(selected(bound, df), bound.raw_where)
    return out.orderBy(*order) if order else out


def run(spark: SparkSession, spec: ReportSpec, dataset: DatasetSpec, df: DataFrame, words: DataFrame | None = None) -> DataFrame:
    return run_details(spark, spec, dataset, df, words) if spec.is_details else run_statistics(spark, spec, dataset, df, words)[0]
